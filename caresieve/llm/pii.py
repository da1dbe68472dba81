"""Personal data: exact patterns, and a character BiLSTM with a CRF that adds what patterns miss."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caresieve.llm.common import arrow_map, pick
from caresieve.llm.pii_model import KINDS, Tagger, codes, trained

#: Windows of so many code points start every STRIDE, so neighbours overlap by 64.
WINDOW, STRIDE = 512, 448
#: A window's span counts if it reaches into the window but for so many places at each end
#: that isn't the text's own; these inner parts cover the text once.
EDGE = (WINDOW - STRIDE) // 2
#: Windows that are tagged at once.
WINDOWS_AT_ONCE = 512
#: The kinds that the patterns know.
BASE_KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: No match starts within a run of digits, as none ends there; without the look behind a long run is tried at each digit.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    """Whether the digits have a right Luhn checksum."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ instead of from each letter before it."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            done = at = m.end()
        else:
            done = at = at + 1


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches that pass their check, by start and then kind as listed."""
    out = [(s, e, "email") for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.findall(m.group())) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def checked(kind: str, span: str) -> bool:
    """What the tagger can't see, as all digits are one sign to it: a card's checksum and count, the range of an address's parts."""
    if kind == "ip":
        return all(len(p) <= 3 and int(p) <= 255 for p in re.findall(r"[0-9]+", span))
    digits = "".join(_DIGITS.findall(span))
    return kind != "card" or 13 <= len(digits) <= 19 and luhn(digits)


def reconcile(found: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str]]:
    """One set of disjoint spans from those of overlapping windows.

    found: (start, end, kind, margin), margin being the distance to the nearer
    window edge that isn't an end of the text. A span that a window cut off
    (margin 0) is joined with an overlapping one of its kind; of other overlapping
    spans the one farther inside its window stays, then the longer, then the first.
    """
    out: list[tuple[int, int, str, int]] = []
    for s, e, kind, margin in sorted(found, key=lambda x: (x[0], -x[1], x[2], -x[3])):
        if out and s < out[-1][1]:
            s0, e0, kind0, margin0 = out[-1]
            if kind == kind0 and not (margin and margin0):
                out[-1] = (s0, max(e, e0), kind, max(margin, margin0))
            elif (margin, e - s) > (margin0, e0 - s0):
                out[-1] = (s, e, kind, margin)
        else:
            out.append((s, e, kind, margin))
    return [x[:3] for x in out]


def model_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, str]]]:
    """The model's spans of each text: all windows tagged in groups, then reconciled over the whole text."""
    todo = [(i, s) for i, t in enumerate(texts) for s in range(0, max(1, len(t) - WINDOW + STRIDE), STRIDE)]
    found: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
    for k in range(0, len(todo), WINDOWS_AT_ONCE):
        part = todo[k : k + WINDOWS_AT_ONCE]
        ids = codes([texts[i][s : s + WINDOW] for i, s in part], WINDOW)
        for (i, s), spans in zip(part, tagger.spans(ids)):
            size = len(texts[i])
            first, last = EDGE if s else 0, WINDOW - EDGE if s + WINDOW < size else WINDOW
            for a, b, kind in spans:
                b = min(b, size - s)
                while a < b and texts[i][s + a].isspace():
                    a += 1
                while b > a and texts[i][s + b - 1].isspace():
                    b -= 1
                if a < b and a < last and b > first:
                    left = a if s else WINDOW
                    right = WINDOW - b if s + WINDOW < size else WINDOW
                    found[i].append((s + a, s + b, kind, min(left, right)))
    return [[x for x in reconcile(f) if checked(x[2], t[x[0] : x[1]])] for t, f in zip(texts, found)]


def all_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, str, bool]]]:
    """(start, end, kind, base) of each text: all pattern spans, and the model's that touch none of them."""
    out = []
    for text, more in zip(texts, model_spans(tagger, texts)):
        base = base_spans(text) if _ANY.search(text) else []
        spans, i, reach = [(*b, True) for b in base], 0, 0
        for s, e, kind in more:
            while i < len(base) and base[i][0] < e:
                reach = max(reach, base[i][1])
                i += 1
            if reach <= s:
                spans.append((s, e, kind, False))
        out.append(sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))
    return out


@lru_cache(maxsize=2)
def _tagger(packed: bytes) -> Tagger:
    return Tagger.unpack(packed)


def _grouped(texts: list[str], most: int = 1 << 22) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size > most:
            yield group
            group, size = [], 0
    if group:
        yield group


def find(docs: DataFrame, tagger: Tagger | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans array<struct<kind, start, end, base>>.

    Places are code points, end exclusive. Whole texts of any length are read, in
    windows of fixed size; null counts as empty and has no spans. Repeated rows give
    repeated rows, an empty table none. Only the two columns are read, so others
    can't clash. Base spans may overlap if their kinds differ; the model's touch no
    other. Without a tagger the one that `trained` reads is used; it is of fixed size
    and broadcast.
    """
    id_type = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast((tagger or trained()).pack())
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches):
        own = _tagger(shared.value)
        for batch in batches:
            spans = [s for texts in _grouped([t or "" for t in batch.column("text").to_pylist()]) for s in all_spans(own, texts)]
            rows = [[{"kind": k, "start": s, "end": e, "base": b} for s, e, k, b in x] for x in spans]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return arrow_map(pick(docs, doc_id=id_col, text=text_col), run, f"doc_id {id_type}, spans array<struct<kind:string,start:int,`end`:int,base:boolean>>")


def redact_text(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """The text with each stretch of spans replaced by the kind of its first, as in [EMAIL]."""
    out, at, cover = [], 0, 0
    for s, e, kind, _ in spans:
        if s >= cover:
            out += [text[at:s], f"[{kind.upper()}]"]
        cover = at = max(cover, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger | None = None, text_col: str = "text") -> DataFrame:
    """docs with personal data in the text replaced; other columns, of any name, and null text stay as they are.

    Whole texts of any length are read; empty text stays empty, equal rows stay
    equal, an empty table gives no rows.
    """
    names, at = docs.columns, docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast((tagger or trained()).pack())

    def run(batches):
        own = _tagger(shared.value)
        for batch in batches:
            raw = batch.column(at).to_pylist()
            texts = [t or "" for t in raw]
            spans = [s for group in _grouped(texts) for s in all_spans(own, group)]
            columns = batch.columns
            columns[at] = pa.array([None if r is None else redact_text(t, s) for r, t, s in zip(raw, texts, spans)], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
