"""SimHash near-dedup: fingerprints, pigeonhole blocks, Hamming verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import arrow_map, cut, pick, salted_join
from caresieve.operators.graph import components

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
#: Blocks of a fingerprint: pairs within MAX_BITS agree on BLOCKS - MAX_BITS of them.
BLOCKS = 5
#: Fingerprints that are compared pair by pair in one task; fuller blocks are split.
FULL_BLOCK = 1 << 14
#: Blocks that a full block's other bits are cut into.
FINE_BLOCKS = 6
#: Blocks that are known to be full before they are dealt out: at most so many, so they may be broadcast.
MAX_CROWDS = 100_000
#: Shingles whose bits are counted at once.
COUNT_AT_ONCE = 1 << 14


def fingerprint(text: str, width: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """64 bits; each is 1 if it is set in over half of the shingles' XXH64."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    total, ones = 0, np.zeros(64, np.int64)
    last = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    for s in range(0, last, COUNT_AT_ONCE):
        part = words[s : min(last, s + COUNT_AT_ONCE) + width - 1]
        runs = [b" ".join(x) for x in zip(*(part[i:] for i in range(width)))] if len(words) >= width else [b" ".join(words)]
        h = np.fromiter((digest(x, seed) for x in runs), np.uint64, len(runs))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(runs)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist()))


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit integer.

    Null, empty and wordless text gives 0. Texts of any length are read whole, their
    shingles a bounded number at a time; repeated rows and null ids give a row each; an
    empty table gives none; only the two columns are read, so others can't clash.
    """
    id_type = dict(docs.dtypes)[id_col]

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, width) if t else 0 for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return arrow_map(pick(docs, doc_id=id_col, text=text_col), run, f"doc_id {id_type}, fp bigint")


def block_masks(blocks: int, free: int, bits: list[int] | None = None) -> list[int]:
    """Masks that keep all but `free` of the blocks that `bits` (all 64) are cut into.

    Fingerprints that differ in up to `free` of these bits agree under one of them.
    """
    bits = list(range(64)) if bits is None else bits
    edges = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    block = [sum(1 << x for x in bits[a:b]) for a, b in zip(edges, edges[1:])]
    return [sum(block[i] for i in keep) for keep in combinations(range(blocks), blocks - free)]


def finer_masks(mask: int, blocks: int, free: int) -> list[int]:
    """Masks that keep this one's bits and all but `free` blocks of the other bits."""
    rest = [i for i in range(64) if not mask >> i & 1]
    return [mask | m for m in block_masks(min(blocks, len(rest)), free, rest)] if len(rest) > free else [mask]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keyed(fps: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """A row (mask, key, fp) per mask of the row's t: the fingerprint's bits under it.

    fps: fp and t, the mask under which the row came here.
    """
    table = F.create_map(*[x for t, ms in masks.items() for x in (F.lit(_signed(t)), F.array(*[F.lit(_signed(m)) for m in ms]))])
    rows = fps.select("fp", F.explode(F.element_at(table, F.col("t"))).alias("mask"))
    return rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _tree(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that join the fingerprints within `most` bits into the same sets as all their links."""
    left, out = np.arange(len(fps)), []
    while len(left) > 1:
        reached, queue = np.zeros(len(left), bool), [0]
        reached[0] = True
        while queue:
            i = queue.pop()
            near = np.flatnonzero(~reached & (np.bitwise_count(fps[left] ^ fps[left[i]]) <= most))
            reached[near] = True
            out += [(int(left[i]), int(left[j])) for j in near]
            queue += near.tolist()
        left = left[~reached]
    return out


def _runs(batches: Iterator[pa.RecordBatch], full: int) -> Iterator[tuple[int, bool, np.ndarray]]:
    """The runs of equal (mask, key) in a sorted stream, of two fingerprints or more: (mask, False, all of a run).

    A run of more than `full` comes as parts, each (mask, True, part). Holds one batch
    and at most `full` fingerprints.
    """
    key, held, over = None, np.zeros(0, np.int64), False
    for batch in batches:
        if not batch.num_rows:
            continue
        t, k, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp"))
        starts = np.concatenate([[0], np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1])
        ends = np.append(starts[1:], len(fps))
        # most runs are single; those at either end may go on in another batch
        look = ends - starts > 1
        look[[0, -1]] = True
        for s, e in zip(starts[look].tolist(), ends[look].tolist()):
            if (t[s], k[s]) != key:
                if len(held) > 1:
                    yield key[0], over, held
                key, held, over = (t[s], k[s]), np.zeros(0, np.int64), False
            held = np.concatenate([held, fps[s:e]])
            if not over and len(held) > full:
                held = np.unique(held)  # one fingerprint may come here from several blocks
            if over or len(held) > full:
                yield key[0], True, held
                held, over = np.zeros(0, np.int64), True
    if len(held) > 1:
        yield key[0], over, held


def _linker(most: int, full: int):
    """A map from sorted (mask, key, fp) to links (a, b, null); fingerprints of too full runs come as (fp, null, mask)."""

    def run(batches):
        for mask, over, fps in _runs(batches, full):
            if over:
                yield pa.RecordBatch.from_arrays([pa.array(fps), pa.nulls(len(fps), pa.int64()), pa.array(np.full(len(fps), mask))], ["a", "b", "t"])
            elif links := _tree(fps.view(np.uint64), most):
                i, j = (np.array(x) for x in zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(fps[i]), pa.array(fps[j]), pa.nulls(len(i), pa.int64())], ["a", "b", "t"])

    return run


def links(fps: DataFrame, most: int = MAX_BITS, blocks: int = BLOCKS, full: int = FULL_BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join the same sets as all pairs within `most` bits.

    fps: one column fp, without repeats. Each block's fingerprints are compared in
    one task, which returns a spanning forest and not the pairs. A block of more than
    `full` is split: its members agree on the block's bits, so they are keyed by
    those and by blocks of the other bits, until the blocks are small or leave so few
    bits free that no more can meet. Blocks that hold over a hundred-thousandth of all
    rows are known from counts and split before any task gets them.
    """
    out, masks = None, {0: block_masks(blocks, most)}
    rows = fps.select("fp", F.lit(0).cast("bigint").alias("t"))
    while True:
        keyed = _keyed(rows, masks)
        n, fan = rows.count(), max(map(len, masks.values()))
        limit = max(full, n * fan // MAX_CROWDS)
        free = max(64 - m.bit_count() for ms in masks.values() for m in ms)
        last = free <= max(most, full.bit_length() - 1)  # so few bits that no more can meet
        apart = None
        if not last and n > limit:
            crowds = cut(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("mask", "key"))
            apart = keyed.join(F.broadcast(crowds), ["mask", "key"], "left_semi").select(F.col("fp").alias("a"), F.lit(None).cast("bigint").alias("b"), F.col("mask").alias("t"))
            keyed = keyed.join(F.broadcast(crowds), ["mask", "key"], "left_anti")
        dealt = keyed.repartition(F.col("mask"), F.col("key")).sortWithinPartitions("mask", "key")
        found = arrow_map(dealt, _linker(most, 1 << free if last else full), "a bigint, b bigint, t bigint")
        found = cut(found.unionByName(apart) if apart is not None else found)
        plain = found.where("b is not null").select("a", "b")
        out = plain if out is None else out.unionByName(plain)
        rows = found.where("b is null").select(F.col("a").alias("fp"), "t").distinct()
        if last or rows.isEmpty():
            return out
        rows = cut(rows)
        split = [r.t & ((1 << 64) - 1) for r in rows.select("t").distinct().collect()]  # masks of this round
        masks = {t: finer_masks(t, FINE_BLOCKS, most) for t in split}


def near_dedup(docs: DataFrame, width: int = SHINGLE_WORDS, most: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, kept.

    Documents are linked when their fingerprints differ in `most` bits or fewer;
    component_id is the smallest id that links reach, itself included, and the
    document of that id is kept. A-Z is lowered; words are split at white space;
    texts with fewer words than a shingle are one shingle. Null text and text
    without words have fingerprint 0 and are linked like any other. Texts may be of any
    length. Rows of equal id share a component; a null id never is the smallest unless
    all are null. Only the two columns are read, so others can't clash. An empty table
    gives no rows.

    Equal fingerprints are one node of the graph, so copies cost one row a task.
    """
    printed = cut(fingerprints(docs, width, id_col, text_col))
    nodes = cut(printed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_docs")))
    reached = cut(components(links(nodes.select("fp"), most)))
    linked = nodes.join(reached, nodes["fp"] == reached["node"], "left").select("fp", "least", "n_docs", F.coalesce("root", "fp").alias("root"))
    linked = cut(linked)
    roots = cut(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n_nodes")))
    named = cut(salted_join(linked, roots, ["root"], "n_nodes", "fp").select("fp", "component_id", "n_docs"))
    out = salted_join(printed, named, ["fp"], "n_docs", "doc_id")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
