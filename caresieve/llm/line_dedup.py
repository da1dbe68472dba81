"""Line dedup: two Bloom filters pick suspected repeats; only those are shuffled and settled exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import arrow_map, cut, free_names, others, quoted, salted_join, slots

MIN_CHARS = 10
#: A filter has one 64-bit word per 8 lines, rounded up to a power of two, up to
#: MAX_WORDS (128 MB); a fuller filter suspects more lines and loses none.
LINES_PER_WORD = 8
MIN_WORDS, MAX_WORDS = 1 << 13, 1 << 24
#: Filters go between tasks in segments of this many words, FAN of them to a task.
SEGMENT_WORDS = 1 << 13
FAN = 32
#: Text bytes that one task fills its filters from, where the cluster's slots don't ask for less.
FILL_BYTES = 4 << 30


def line_keys(text: str) -> list[bytes | None]:
    """For each line its key, or None where the key has under MIN_CHARS code points."""
    keys = []
    for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n"):  # bytes.lower() changes A-Z only
        key = line.strip(b" \t\n\x0b\x0c\r")
        n = len(key)
        if n >= 4 * MIN_CHARS or n >= MIN_CHARS and len(key.decode("utf-8", "surrogatepass")) >= MIN_CHARS:
            keys.append(key)
        else:
            keys.append(None)
    return keys


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))


def _place(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and mask of each hash: three bits of one word."""
    one = np.uint64(1)
    mask = np.zeros(len(h), np.uint64)
    for shift in (58, 52, 46):
        mask |= one << ((h >> np.uint64(shift)) & np.uint64(63))
    return (h & np.uint64(words - 1)).astype(np.int64), mask


def _or_into(bits: np.ndarray, at: np.ndarray, mask: np.ndarray) -> None:
    if len(at):
        order = np.argsort(at, kind="stable")
        at, first = np.unique(at[order], return_index=True)
        bits[at] |= np.bitwise_or.reduceat(mask[order], first)


class TwoFilters:
    """Which hashes came once at least, and which perhaps twice."""

    def __init__(self, words: int):
        self.once, self.twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)

    def add(self, h: np.ndarray) -> None:
        """h: hashes, each as often as it was seen."""
        unique, n = np.unique(h, return_counts=True)
        at, mask = _place(unique, len(self.once))
        again = (n > 1) | ((self.once[at] & mask) == mask)
        _or_into(self.twice, at[again], mask[again])
        _or_into(self.once, at, mask)


def suspected(twice: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may have come twice; never False for one that has."""
    at, mask = _place(h, len(twice))
    return (twice[at] & mask) == mask


def _version(text: str) -> bytes:
    """What tells the texts of one id apart."""
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def _distinct(text: str) -> list[bytes]:
    keys = set(line_keys(text))
    keys.discard(None)
    return list(keys)


def _filters(docs: DataFrame, words: int, size: int = 0) -> np.ndarray:
    """The twice filter over all documents.

    Each of a bounded number of tasks fills its own pair of filters, from FILL_BYTES
    of text at most, size being the bytes of all. Pairs merge segment by segment, FAN at a time: a bit of `twice` is one that either had
    there or both had in `once`.
    """
    tasks = max(2 * slots(docs), -(-size // FILL_BYTES))

    def fill(batches):
        from pyspark import TaskContext

        f = TwoFilters(words)
        for batch in batches:
            f.add(np.concatenate([np.zeros(0, np.uint64), *(_hashes(_distinct(t.as_py() or "")) for t in batch.column("text"))]))
        n = max(1, words // SEGMENT_WORDS)
        for s in range(0, n, 64):
            take = [slice(i * SEGMENT_WORDS, (i + 1) * SEGMENT_WORDS) for i in range(s, min(n, s + 64))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(s, s + len(take)), pa.int32()),
                    pa.array([TaskContext.get().partitionId()] * len(take), pa.int32()),
                    pa.array([f.once[x].tobytes() for x in take], pa.binary()),
                    pa.array([f.twice[x].tobytes() for x in take], pa.binary()),
                ],
                ["seg", "part", "once", "twice"],
            )

    def merge(table: pa.Table) -> pa.Table:
        once = twice = None
        for batch in table.select(["once", "twice"]).to_batches():
            for o, t in zip(batch.column(0), batch.column(1)):
                o, t = (np.frombuffer(x.as_buffer(), np.uint64) for x in (o, t))
                once, twice = (o.copy(), t.copy()) if once is None else (once | o, twice | t | (once & o))
        return pa.table(
            {
                "seg": table.column("seg").slice(0, 1),
                "part": pa.array([table.column("part")[0].as_py() // FAN], pa.int32()),
                "once": pa.array([once.tobytes()], pa.binary()),
                "twice": pa.array([twice.tobytes()], pa.binary()),
            }
        )

    schema = "seg int, part int, once binary, twice binary"
    pairs = arrow_map(docs.select("text").coalesce(tasks), fill, schema)
    while tasks > 1:
        pairs = pairs.groupBy("seg", F.floor(F.col("part") / FAN).cast("int").alias("g")).applyInArrow(merge, schema)
        tasks = -(-tasks // FAN)
    twice = np.zeros(words, np.uint64)
    for seg, bits in pairs.select("seg", "twice").toLocalIterator():
        twice[seg * SEGMENT_WORDS : (seg + 1) * SEGMENT_WORDS] = np.frombuffer(bytes(bits), np.uint64)
    return twice


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """Documents without the lines that an earlier document (smaller id) holds.

    A line counts by its key: white space stripped at both ends, A-Z lowered; only
    keys of MIN_CHARS code points or more. A key of two or more documents keeps its
    lines, however many, in the document of the smallest id alone. All columns
    return, the text shortened, with n_lines (before) and n_dropped, which replace
    columns of these names; no other name clashes. Null and empty text are one empty
    line; the text is then empty. Texts and lines may be of any length. Rows of equal
    id are one document, repeated rows stay; rows without an id lose nothing. An empty
    table gives no rows.

    Documents in which no line is suspected pass without a shuffle. Joins on lines go
    by a 128-bit hash, with the bytes compared after it.
    """
    names = others(docs, ("n_lines", "n_dropped"))
    docs = docs.select(*quoted(names))
    core = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held = F.octet_length("text")
    n, size = (x or 0 for x in core.agg(F.sum(held - F.octet_length(F.replace(F.col("text"), F.lit("\n"))) + 1), F.sum(held)).first())
    words = MIN_WORDS
    while words < min(max_words, n / LINES_PER_WORD):
        words *= 2
    twice = docs.sparkSession.sparkContext.broadcast(_filters(core, words, size).tobytes())
    id_type = dict(docs.dtypes)[id_col]

    def probe(batches):
        bits = np.frombuffer(twice.value, np.uint64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [_distinct(t) if t and i is not None else [] for i, t in zip(batch.column("id").to_pylist(), texts)]
            keys = [k for ks in found for k in ks]
            row = np.repeat(np.arange(len(found)), [len(ks) for ks in found])
            hit = np.flatnonzero(suspected(bits, _hashes(keys)))
            for s in range(0, len(hit), 50_000):
                part = hit[s : s + 50_000]
                some = [keys[i] for i in part]
                whole = [_version(texts[i]) if texts[i] else b"" for i in row[part]]
                digests = pa.array([xxhash.xxh3_128_digest(k) for k in some], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row[part])), pa.array(whole, pa.binary()), digests, pa.array(some, pa.binary())], ["id", "version", "hash", "key"])

    suspects = cut(arrow_map(core, probe, f"id {id_type}, version binary, hash binary, key binary"))
    repeats = suspects.groupBy("hash", "key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n_rows"))
    repeats = cut(repeats.where("first < last").drop("last").withColumnRenamed("key", "same"))
    lost = salted_join(suspects, repeats, ["hash"], "n_rows", "id").where("id > first and key = same")
    lost_id, lost_version, lost_keys, version = free_names(docs.columns, "lost_id", "lost_version", "lost_keys", "version")
    # of each text of an id its own lines, so no row gets more than it has itself
    lost = lost.groupBy(F.col("id").alias(lost_id), F.col("version").alias(lost_version)).agg(F.collect_set("key").alias(lost_keys))

    kept_fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    schema = ", ".join([*kept_fields, "n_lines bigint", "n_dropped bigint"])
    at, key_at = names.index(text_col), names.index(id_col)

    def clean(batches):
        """Rows none of whose lines is suspected: they are done."""
        yield from _rows(batches, want=False)

    def doubtful(batches):
        yield from _rows(batches, want=True)

    def _rows(batches, want):
        bits = np.frombuffer(twice.value, np.uint64)
        for batch in batches:
            texts, ids = batch.column(at).to_pylist(), batch.column(key_at).to_pylist()
            found = [_distinct(t) if t and i is not None else [] for i, t in zip(ids, texts)]
            hit = suspected(bits, _hashes([k for ks in found for k in ks]))
            ends = np.concatenate([[0], np.cumsum([len(ks) for ks in found])])
            flags = np.array([hit[a:b].any() for a, b in zip(ends[:-1], ends[1:])], bool)
            chosen = pa.array(np.flatnonzero(flags == want))
            out = batch.take(chosen)
            if not want:
                kept = [texts[i] or "" for i in chosen.to_pylist()]
                columns = out.columns
                columns[at] = pa.array(kept, out.schema.field(at).type)
                columns += [pa.array([t.count("\n") + 1 for t in kept], pa.int64()), pa.array([0] * len(kept), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])
            else:
                versions = [_version(texts[i]) for i in chosen.to_pylist()]
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(versions, pa.binary())], [*names, version])

    def drop(batches):
        for batch in batches:
            texts, losses = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
            kept, before, gone = [], [], []
            for text, loss in zip(texts, losses):
                text = text or ""
                lines = text.split("\n")
                before.append(len(lines))
                if loss:
                    bad = set(loss)
                    lines = [x for x, k in zip(lines, line_keys(text)) if k not in bad]
                    text = "\n".join(lines)
                kept.append(text)
                gone.append(before[-1] - len(lines))
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(kept, batch.schema.field(at).type)
            columns += [pa.array(before, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])

    sure = arrow_map(docs, clean, schema)
    rest = arrow_map(docs, doubtful, ", ".join([*kept_fields, f"{version} binary"]))
    # both sides are sorted and may spill; rows of an id that is very often repeated are split by the adaptive join
    rest = rest.join(lost.hint("merge"), (rest[id_col] == lost[lost_id]) & (rest[version] == lost[lost_version]), "left").select(*quoted(names), lost_keys)
    return sure.unionByName(arrow_map(rest, drop, schema))
