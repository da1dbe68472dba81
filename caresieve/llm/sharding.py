"""Sharding by proportional stratified interleaving, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresieve.llm.common import cut, null_safe_key, pick

SHARDS = 16
SEED = "shard-1"
#: Rows are ranked in buckets of about this many, at most MAX_BUCKETS of them.
BUCKET_ROWS = 512
MAX_BUCKETS = 1 << 16
#: Equal rows that one task makes from their count.
COPIES = 4096


def _unit(key: Column) -> Column:
    """A number in [0, 1) from an md5 in hex."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _each(groups: DataFrame) -> DataFrame:
    """A row per copy of each group of equal rows, numbered from 0 in `copy`; very many are dealt over tasks."""
    few = groups.where(F.col("m") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    runs = groups.where(F.col("m") > COPIES).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(COPIES).cast("long"))))
    last = F.least(F.col("first") + COPIES, F.col("m")) - 1
    many = runs.repartition("key", "first").withColumn("copy", F.explode(F.sequence(F.col("first"), last))).drop("first")
    return few.unionByName(many)


def interleave(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, rank, share, law, shard, slot, grown_shard.

    Within each source rows are ordered by a seeded hash of id, size and checksum; the
    row of rank r of n gets the fractional rank (r - 1 + u) / n, u in [0, 1) seeded by
    source. All rows in the order of this share are cut into `shards` runs whose counts are
    at most one apart (law `rows`); so each run holds each source in proportion.
    slot counts from 0 in each shard. size is the UTF-8 bytes of the text plus 1,
    text_crc32 the CRC-32 of the text; null text counts as empty, null source is a
    source of its own, null ids are equal. Rows of one id are spread by their content;
    rows that are equal in all that the order looks at are counted as one and follow each
    other, so it doesn't matter which is which, and the result depends on the rows alone
    and not on files or partitions. Whole texts of any length are read, once; other
    columns aren't. An empty table gives no rows.

    No rank needs all rows of a source, or all rows, in one task: hash buckets are
    ranked apart, and small tables of their counts give the offsets.
    """
    base = pick(docs, doc_id=id_col, text=text_col, source=source_col)
    text = F.coalesce("text", F.lit(""))
    base = base.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    base = base.groupBy("doc_id", "source", "size", "text_crc32").agg(F.count(F.lit(1)).alias("m"))
    key = F.md5(F.concat_ws(":", F.lit(seed), null_safe_key(F.col("doc_id")), F.col("size"), F.col("text_crc32")))
    base = cut(base.withColumn("stratum", null_safe_key(F.col("source"))).withColumn("key", key))  # rows of fixed size, read several times
    n = base.agg(F.sum("m")).first()[0] or 0
    buckets = max(1, min(MAX_BUCKETS, -(-n // BUCKET_ROWS)))
    base = base.withColumn("bucket", F.floor(_unit(F.col("key")) * buckets).cast("int"))

    ties = ["key", "doc_id", "size", "text_crc32"]
    counts = base.groupBy("stratum", "bucket").agg(F.sum("m").alias("m"))
    by_stratum = Window.partitionBy("stratum")
    earlier = by_stratum.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("stratum", "bucket", F.sum("m").over(by_stratum).alias("n"), F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"))
    place = F.coalesce(F.sum("m").over(Window.partitionBy("stratum", "bucket").orderBy(*ties).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = _each(base.withColumn("place", place)).join(counts, ["stratum", "bucket"])
    start = _unit(F.md5(F.concat_ws(":", F.lit(seed), F.col("stratum"))))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("place") + F.col("copy") + 1)
    ranked = ranked.withColumn("share", (F.col("rank") - 1 + start) / F.col("n"))
    ranked = cut(ranked.select("doc_id", "source", "size", "text_crc32", "key", "rank", "share"))

    ranked = ranked.withColumn("bucket", F.least(F.floor(F.col("share") * buckets), F.lit(buckets - 1)).cast("int"))
    filled = ranked.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"))  # at most MAX_BUCKETS rows
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.select("bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("share", *ties))
    placed = ranked.withColumn("place", place).join(F.broadcast(filled), "bucket")
    at = F.col("before") + F.col("place") - 1
    placed = placed.withColumn("at", at).withColumn("shard", F.expr(f"int((at * {shards}) div {max(n, 1)})"))
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "source", "size", "text_crc32", "rank", "share", F.lit("rows").alias("law"), "shard", (F.col("at") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
