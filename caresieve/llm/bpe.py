"""Byte-level BPE: encoding with the tiktoken library from a local rank file, and decoding to raw bytes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from caresieve.llm.common import arrow_map, pick

#: Texts of more code points than this are encoded in pieces of about this size.
PIECE_CHARS = 1 << 16
#: A rank file is sent to every executor; larger files are refused.
MAX_RANK_BYTES = 64 << 20
#: Documents whose ids are held at once before a batch goes back to Spark.
OUT_TOKENS = 1 << 21

#: No match of the pattern has white space after another character, so a cut
#: between the two leaves every match whole. Only characters that every
#: definition counts as no white space may stand before the cut.
_CUT = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n])")


@lru_cache(maxsize=4)
def _encoding(raw: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """text cut at safe boundaries into parts of at least `size` (the last: any size)."""
    start = 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def encode_text(encoding: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> np.ndarray:
    """The ids of a text as unsigned 32-bit little-endian integers."""
    return np.concatenate([np.array(encoding.encode_ordinary(p), dtype="<u4") for p in pieces(text, size)])


def _rank_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MAX_RANK_BYTES + 1)
    if len(raw) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return raw


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, decoded: bool = False) -> DataFrame:
    """Encodes every whole text; no shuffle.

    Returns doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned
    32-bit integers); with `ids` token_ids array<int>; with `decoded` the text's
    bytes rebuilt from the ids alone as decoded binary, else their decoded_sha256.
    Null and empty text have no ids; texts of any length are cut at safe places.
    Repeated rows give repeated rows, an empty table none. Only the two columns are
    read, so others can't clash. The merges are unique, so there are no ties. The rank
    file is read once on the driver (at most MAX_RANK_BYTES) and broadcast, so
    executors need no file of their own.
    """
    id_type = dict(docs.dtypes)[id_col]
    ranks = docs.sparkSession.sparkContext.broadcast(_rank_bytes(rank_path))
    fields = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, " + ("token_ids array<int>, " if ids else "") + ("decoded binary" if decoded else "decoded_sha256 string")

    def run(batches):
        encoding = _encoding(ranks.value, pattern)

        def out(rows):
            doc_ids, arrays, raws = (list(x) for x in zip(*rows))
            columns = [
                pa.concat_arrays(doc_ids),
                pa.array([len(a) for a in arrays], pa.int64()),
                pa.array([hashlib.sha256(a.tobytes()).hexdigest() for a in arrays]),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256"]
            if ids:
                offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype("i4")
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype("i4"))))
                names.append("token_ids")
            columns.append(pa.array(raws, pa.binary()) if decoded else pa.array(raws))
            names.append("decoded" if decoded else "decoded_sha256")
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            held, rows = 0, []
            for i, text in enumerate(batch.column("text")):
                a = encode_text(encoding, text.as_py() or "")
                raw = encoding.decode_bytes(a.tolist())
                rows.append((batch.column("doc_id").slice(i, 1), a, raw if decoded else hashlib.sha256(raw).hexdigest()))
                held += len(a) + 64
                if held > OUT_TOKENS:
                    yield out(rows)
                    held, rows = 0, []
            if rows:
                yield out(rows)

    return arrow_map(pick(docs, doc_id=id_col, text=text_col), run, fields)


def decode(tokens: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """doc_id and the raw bytes of each row's ids, which need not be whole UTF-8.

    Null ids give null bytes, no ids none; lists may be of any length; repeated rows
    give repeated rows, an empty table none. Other columns aren't read.
    """
    id_type = dict(tokens.dtypes)[id_col]
    ranks = tokens.sparkSession.sparkContext.broadcast(_rank_bytes(rank_path))

    def run(batches):
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            raws = [None if x is None else encoding.decode_bytes(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raws, pa.binary())], ["doc_id", "bytes"])

    return arrow_map(pick(tokens, doc_id=id_col, ids=ids_col), run, f"doc_id {id_type}, bytes binary")
