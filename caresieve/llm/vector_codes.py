"""Compression of vectors to codes: product quantisation whose Lloyd rounds compare trees of points with trees of entries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import arrow_map, cut, null_safe_key, pick, salted_join

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Components become floor(SCALE * x).
SCALE = 256
#: Integers beyond this could overflow sums of squares.
MOST = 1 << 26
#: Rows whose trees are built at once, and points of a leaf.
BLOCK_ROWS, LEAF = 1 << 13, 8


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


@dataclass
class Tree:
    """A balanced tree over points of several parts: order, and boxes by level, the root first.

    order: (parts, n) places of the points, so that node i of level k holds the i-th
    of 2**k equal runs; n is a power of two times the leaf size.
    """

    order: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]


def build(points: np.ndarray, levels: int) -> Tree:
    """Splits each node at the median of its widest dimension; points: (parts, n, width), n divisible by 2**levels."""
    parts, n, width = points.shape
    order = np.broadcast_to(np.arange(n), (parts, n)).copy()
    rows = np.arange(parts)[:, None]
    low, high = [], []
    for level in range(levels + 1):
        nodes = points[rows, order].reshape(parts, 1 << level, n >> level, width)
        low.append(nodes.min(axis=2))
        high.append(nodes.max(axis=2))
        if level < levels:
            widest = (high[-1] - low[-1]).argmax(axis=2)
            along = np.take_along_axis(nodes, widest[:, :, None, None], axis=3)[..., 0]
            within = along.argsort(axis=2, kind="stable") + (np.arange(1 << level) * (n >> level))[None, :, None]
            order = np.take_along_axis(order, within.reshape(parts, n), axis=1)
    return Tree(order, low, high)


def _bounds(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between points of two boxes, row by row."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    reach = np.maximum(high_a - low_b, high_b - low_a)
    return (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)


def assign(points: np.ndarray, weight: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The nearest entry of each point, ties to the lower index: (codes, sums, counts, points whose distances were computed).

    points: (parts, n, width) integers; weight: (n,) 1, or 0 for padding; entries:
    (parts, m, width). Both trees are descended together: a pair of a point node and
    an entry node is dropped when another entry node is nearer for certain. A point
    node left with one entry goes to it whole, with its cached sums; points of leaves
    with several entries are compared with those in integers.
    """
    parts, n, width = points.shape
    m = entries.shape[1]
    levels = max(0, (n // LEAF).bit_length() - 1)
    tree = build(points, levels)
    e_levels = max(0, (m - 1).bit_length())
    padded = np.concatenate([entries, np.repeat(entries[:, -1:], (1 << e_levels) - m, axis=1)], axis=1)  # copies of the last entry come after it, so ties leave them out
    e_tree = build(padded, e_levels)
    number = np.minimum(e_tree.order, m - 1)

    ordered = np.take_along_axis(points, tree.order[:, :, None], axis=1)
    w = weight[tree.order]
    cached = (ordered * w[:, :, None]).reshape(parts, 1 << levels, n >> levels, width).sum(axis=2)
    cached_n = w.reshape(parts, 1 << levels, n >> levels).sum(axis=2)
    codes, sums, counts = np.full((parts, n), -1, np.int64), np.zeros((parts, m, width), np.int64), np.zeros((parts, m), np.int64)

    part, node, entry = np.arange(parts), np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    level = e_level = 0
    while True:
        least, most = _bounds(tree.low[level][part, node], tree.high[level][part, node], e_tree.low[e_level][part, entry], e_tree.high[e_level][part, entry])
        group = part << level | node
        bound = np.full(parts << level, np.iinfo(np.int64).max)
        np.minimum.at(bound, group, most)
        keep = least <= bound[group]
        part, node, entry, group = part[keep], node[keep], entry[keep], group[keep]
        if e_level == e_levels:
            left = np.bincount(group, minlength=parts << level)
            # several copies of one entry, or entries of equal place, are settled as points
            sure = left[group] == 1
            if sure.any():
                p, x, e = part[sure], node[sure], number[part[sure], entry[sure]]
                size, leaves = n >> level, 1 << (levels - level)
                span = x[:, None] * size + np.arange(size)
                codes[p[:, None], tree.order[p[:, None], span]] = e[:, None]
                np.add.at(sums, (p, e), cached.reshape(parts, 1 << level, leaves, width).sum(axis=2)[p, x])
                np.add.at(counts, (p, e), cached_n.reshape(parts, 1 << level, leaves).sum(axis=2)[p, x])
                part, node, entry = part[~sure], node[~sure], entry[~sure]
        if level == levels and e_level == e_levels or not len(part):
            break
        if e_level < e_levels:
            part, node = np.repeat(part, 2), np.repeat(node, 2)
            entry = (entry[:, None] * 2 + [0, 1]).ravel()
            e_level += 1
        if level < levels:
            part, entry = np.repeat(part, 2), np.repeat(entry, 2)
            node = (node[:, None] * 2 + [0, 1]).ravel()
            level += 1

    compared = 0
    if len(part):
        size = n >> levels
        leaf, row = np.unique(part << levels | node, return_inverse=True)
        best = np.full((len(leaf), size, m), np.iinfo(np.int64).max)
        span = node[:, None] * size + np.arange(size)
        e = number[part, entry]
        gap = ordered[part[:, None], span] - entries[part, e][:, None, :]
        best[row, :, e] = (gap * gap).sum(axis=2)
        chosen = best.argmin(axis=2)
        p, x = leaf >> levels, leaf & ((1 << levels) - 1)
        span = x[:, None] * size + np.arange(size)
        codes[p[:, None], tree.order[p[:, None], span]] = chosen
        own = w[p[:, None], span]
        np.add.at(sums, (np.repeat(p, size), chosen.ravel()), (ordered[p[:, None], span] * own[:, :, None]).reshape(-1, width))
        np.add.at(counts, (np.repeat(p, size), chosen.ravel()), own.ravel())
        compared = int(own.sum())
    return codes, sums, counts, compared


def _blocks(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(rows, points, weights) of at most BLOCK_ROWS rows each, filled up to a size that splits evenly."""
    width = len(batch.column("q")[0]) // parts
    flat = batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, width)
    for s in range(0, len(flat), BLOCK_ROWS):
        block = flat[s : s + BLOCK_ROWS]
        n = len(block)
        full = LEAF
        while full < n:
            full *= 2
        block = np.concatenate([block, np.repeat(block[-1:], full - n, axis=0)])
        yield n, np.ascontiguousarray(block.transpose(1, 0, 2)), (np.arange(full) < n).astype(np.int64)


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and q, the integer components, of the vectors that can be coded."""
    rows = pick(vectors, vec_id=id_col, label=label_col, v=vector_col).where(usable(F.col("v")))
    q = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return rows.select("vec_id", "label", q.alias("q")).where(F.size("q") > 0)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of rows with vec_id and q, as `integers` gives them.

    A round adds sums and counts up in each task, so entries times components rows a
    task are shuffled, and as many numbers reach the driver. No rows: no entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256, as a code has two hex digits a part")
    least, most, reach = rows.agg(F.min(F.size("q")), F.max(F.size("q")), F.max(F.greatest(F.array_max("q"), -F.array_min("q")))).first()
    if least is None:
        return np.zeros((parts, 0, 0), np.int64)
    if least != most or least % parts:
        raise ValueError(f"vectors of {least} to {most} components can't be cut into {parts} equal parts")
    if reach >= MOST:
        raise ValueError(f"components reach {reach / SCALE:g}; {MOST // SCALE} is the bound of exact sums")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()  # so many rows, whatever the table's size
    books = np.array([r.q for r in first], np.int64).reshape(len(first), parts, least // parts).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _updated(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """rows (vec_id, label, q) with code, the nearest entries of the parts in hex, and error, the squared distances' sum, in place of q."""
    id_type, label_type = (dict(rows.dtypes)[c] for c in ("vec_id", "label"))
    shared = rows.sparkSession.sparkContext.broadcast(books.tobytes())
    shape = books.shape

    def code(batches):
        own = np.frombuffer(shared.value, np.int64).reshape(shape)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, errors = [], []
            for n, points, weight in _blocks(batch, shape[0]):
                at = assign(points, weight, own)[0]
                gap = points - own[np.arange(shape[0])[:, None], at]
                errors.append((gap * gap).sum(axis=(0, 2))[:n])
                codes += [x.tobytes().hex() for x in np.ascontiguousarray(at.T[:n].astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(np.concatenate(errors))], ["vec_id", "label", "code", "error"])

    return arrow_map(rows, code, f"vec_id {id_type}, label {label_type}, code string, error bigint")


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id and vector: for rows (vec_id, code) what the codes' entries stand for, in the middle of each integer's step."""
    shared = codes.sparkSession.sparkContext.broadcast(books.tobytes())
    shape = books.shape

    def restore(batches):
        own = np.frombuffer(shared.value, np.int64).reshape(shape)
        for batch in batches:
            at = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, shape[0])
            values = (own[np.arange(shape[0]), at] + 0.5) / SCALE
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(list(values.reshape(len(at), -1)), pa.list_(pa.float64()))], ["vec_id", "vector"])

    return arrow_map(codes.select("vec_id", "code"), restore, f"vec_id {dict(codes.dtypes)['vec_id']}, vector array<double>")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector that can be coded: vec_id, code, error, label_error, codebooks_sha256.

    Components become floor(256 * x); each of `parts` equal parts has a codebook of
    its own that starts as that part of the vectors of the `entries` smallest ids
    (of equal ids those that sort first; null ids last). Each round gives every part
    its nearest entry, ties to the lower index, and every used entry the floor of its
    parts' mean. code has two hex digits a part; error sums the squared distances;
    label_error sums errors of equal labels, null labels together. Vectors that are
    null or empty or hold a null or non-finite component are left out. All others
    must have one length that the parts divide, and components under 2**18: others
    raise an error, as the sums would not be exact. Repeated rows give repeated rows;
    an empty table gives none; other columns aren't read, so names can't clash.
    """
    rows = integers(vectors, id_col, vector_col, label_col)
    books = train(rows, parts, entries, rounds)
    if not books.shape[1]:
        return rows.sparkSession.createDataFrame([], f"vec_id {dict(rows.dtypes)['vec_id']}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = cut(encode(rows, books).select("vec_id", "code", "error", null_safe_key(F.col("label")).alias("stratum")))
    totals = cut(coded.groupBy("stratum").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")))
    out = salted_join(coded, totals, ["stratum"], "n", "code")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _updated(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all rows; entries that no part is nearest to stay."""
    parts, m, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books.tobytes())

    def add_up(batches):
        own = np.frombuffer(shared.value, np.int64).reshape(parts, m, width)
        sums, counts = np.zeros((parts, m, width), np.int64), np.zeros((parts, m), np.int64)
        for batch in batches:
            for _, points, weight in _blocks(batch, parts) if batch.num_rows else ():
                _, s, c, _ = assign(points, weight, own)
                sums += s
                counts += c
        used = np.flatnonzero(counts.ravel())
        at = np.repeat(used * width, width) + np.tile(np.arange(width), len(used))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.ravel()[at]), pa.array(counts.ravel()[at // width])], ["at", "total", "n"])

    found = arrow_map(rows.select("q"), add_up, "at bigint, total bigint, n bigint")
    found = found.groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = books.copy().ravel()
    for r in found.collect():  # at most as many numbers as the codebooks hold
        out[r["at"]] = r.total // r.n
    return out.reshape(books.shape)
