"""Exact dedup by an extendible-hash index on shared files, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresieve.llm.common import SPACES, cut, pick, salted_join

#: Entries that a bucket holds before the directory splits it.
BUCKET_ROWS = 50_000
#: The directory has at most 2 ** MAX_DEPTH cells, at any size of the corpus.
MAX_DEPTH = 16
#: Text bytes of an owner task.
OWNER_BYTES = 64 << 20
#: Texts of over this many copies, or bytes in all copies, are merged before they go to their owner;
#: the limits grow with the corpus, so that there are at most 2 * HOT_TEXTS of them.
HOT_COPIES, HOT_BYTES, HOT_TEXTS = 256, 16 << 20, 100_000


def directory(counts: dict[int, int], depth: int = MAX_DEPTH, capacity: int = BUCKET_ROWS) -> list[tuple[int, int, int]]:
    """(first cell, local depth, entries) of each bucket, in key order.

    counts: entries by cell, a cell being the first `depth` bits of the hash. The
    directory starts with one bucket; while a bucket is overfull it is split on
    its next bit, and the directory doubles when the bucket was as deep as it.
    A bucket that is overfull at the full depth keeps its overflow in a chain.
    """
    sums = [[0] * (1 << depth)]
    for cell, n in counts.items():
        sums[0][cell] += n
    for _ in range(depth):
        last = sums[-1]
        sums.append([last[i] + last[i + 1] for i in range(0, len(last), 2)])
    buckets, todo = [], [(0, 0)]
    while todo:
        local, prefix = todo.pop()
        n = sums[depth - local][prefix]
        if n > capacity and local < depth:
            todo += [(local + 1, 2 * prefix + 1), (local + 1, 2 * prefix)]
        else:
            buckets.append((prefix << (depth - local), local, n))
    return buckets


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _cell(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - MAX_DEPTH).cast("int")


def _owners(cells: list[tuple[int, int, int]], capacity: int, owners: int) -> list[tuple[int, int, int, int]]:
    """(bucket, owner, first cell, cells) from (cell, entries, bytes): each owner has a run of buckets of like bytes."""
    weight = [0] * ((1 << MAX_DEPTH) + 1)  # bytes before each cell
    for cell, _, size in cells:
        weight[cell + 1] += size
    for i in range(1 << MAX_DEPTH):
        weight[i + 1] += weight[i]
    total = max(1, weight[-1])
    buckets = directory({cell: n for cell, n, _ in cells}, MAX_DEPTH, capacity)
    return [(b, min(owners - 1, weight[first] * owners // total), first, 1 << (MAX_DEPTH - local)) for b, (first, local, _) in enumerate(buckets)]


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_ROWS, hash_of: Callable[[Column], Column] = F.xxhash64
) -> tuple[DataFrame, DataFrame]:
    """(entries, index), both on the shared files of the checkpoint folder.

    entries: one row per document: bucket, h (64-bit hash of the normalised text),
    sha, doc_id, n_points, and row, a number of its own.
    index: one row per distinct text: bucket, h, chain (its place among the texts of
    one hash), sha, group_size, keep_id, keep_points.

    The directory routes: a hash prefix has a bucket, and a run of buckets has an
    owner task, to which the texts go. The owner sorts its keys and compares the
    bytes of neighbours of one hash: equal ones are one entry, others follow each
    other in the chain. Texts of very many copies are merged by the tasks that read
    them, so a group moves once a task whatever its size; memory is that of a sort
    that may spill. A bad hash makes long chains and no wrong groups.
    """
    spark = docs.sparkSession
    norm = normalised(F.col("text"))
    base = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"), norm.alias("norm"))
    base = base.withColumn("h", hash_of(F.col("norm")))
    plain = base.select("doc_id", "h", "n_points", F.octet_length("norm").cast("long").alias("n_bytes"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    plain = cut(plain.withColumn("row", F.monotonically_increasing_id()))

    hashes = cut(plain.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("size")))
    total = hashes.agg(F.sum("n").alias("n"), F.sum("size").alias("size")).first()
    n_all, size_all = total.n or 0, total.size or 0
    many, large = max(HOT_COPIES, n_all // HOT_TEXTS), max(HOT_BYTES, size_all // HOT_TEXTS)
    is_hot = (F.col("n") > many) | ((F.col("size") > large) & (F.col("n") > 1))
    hot = hashes.where(is_hot).select("h")

    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size_all // OWNER_BYTES))
    share = F.when(is_hot, F.least(F.col("n"), F.lit(many))).otherwise(F.col("n"))
    cells = hashes.groupBy(_cell(F.col("h")).alias("cell")).agg(F.sum(share).alias("n"), F.sum(share * (F.col("size") / F.col("n"))).cast("long").alias("size"))
    cells = cells.toArrow().to_pylist()  # at most 2 ** MAX_DEPTH rows
    capacity = max(min(capacity, n_all // (8 * owners)), 4 * n_all >> MAX_DEPTH, 1)
    spans = spark.createDataFrame(_owners([(c["cell"], c["n"], c["size"]) for c in cells], capacity, owners), "bucket int, owner int, first int, span int")
    cells = F.broadcast(spans.select("bucket", "owner", F.explode(F.expr("sequence(first, first + span - 1)")).alias("cell")))

    def routed(df: DataFrame) -> DataFrame:
        return df.join(cells, _cell(F.col("h")) == F.col("cell")).drop("cell")

    # keep: most code points, then the smallest id, null ids last
    rank = F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("last"), "doc_id")
    texts = base.join(F.broadcast(hot), "h", "left_anti").select("h", "norm", F.lit(1).cast("long").alias("n"), rank.alias("rank"))
    if not hot.isEmpty():
        copied = base.join(F.broadcast(hot), "h", "left_semi").groupBy("h", "norm").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("rank"))
        texts = texts.unionByName(copied)
    owned = routed(texts).repartitionById(owners, F.col("owner"))
    groups = owned.groupBy("owner", "bucket", "h", "norm").agg(F.sum("n").alias("group_size"), F.min("rank").alias("rank"))
    chain = F.row_number().over(Window.partitionBy("owner", "bucket", "h").orderBy("norm"))
    index = groups.select("bucket", "h", chain.alias("chain"), F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size", F.col("rank.doc_id").alias("keep_id"), (-F.col("rank.less")).alias("keep_points"))
    return routed(plain).drop("owner", "n_bytes"), cut(index)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_ROWS, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when they are without white space; null counts as empty. The
    row with the most code points, then the smallest id, stays; of rows that are
    equal in all this, one. A null id ranks last. Whole texts of any length are
    compared. Only the two columns are read, so others can't clash. An empty table
    gives no rows.

    A document finds its entry in its bucket, by hash and digest.
    """
    entries, index = build_index(docs, id_col, text_col, capacity, hash_of)
    found = salted_join(entries, index, ["bucket", "h", "sha"], "group_size", "row")
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))
    found = cut(found.select("bucket", "h", "chain", "sha", "doc_id", "row", "keep_id", "group_size", best.alias("best")))
    # rows of one id may all be the best: the first of them stays
    tied = found.where("best")
    firsts = cut(tied.groupBy("bucket", "h", "chain").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n_tied")))
    tied = salted_join(tied, firsts, ["bucket", "h", "chain"], "n_tied", "row").withColumn("kept", F.col("row") == F.col("first"))
    out = found.where("not best").withColumn("kept", F.lit(False)).unionByName(tied.drop("first", "n_tied"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"), "bucket", "chain")
