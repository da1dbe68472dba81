"""Exact quantiles of columns of any length, by ranks over a range sort instead of one task's values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caresieve.operators.skew import cut


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """(keys..., n, quantiles): per key the linearly interpolated quantiles of its values that are neither null nor NaN.

    Equal values are counted before anything is sorted. The different values are
    sorted in ranges, and counts of each range give its first rank, so no task holds
    all values of a key. Keys without a value give no row.
    """
    spark = df.sparkSession
    x = F.col(value).cast("double")
    counts = df.select(*keys, x.alias("x")).where("x is not null and not isnan(x)").groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("m"))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(counts.repartitionByRange(parts, *keys, "x").withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy(*keys, "part").agg(F.sum("m").alias("m"))  # a row for each key of each range
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"), F.sum("m").over(by_key).alias("n"))
    within = Window.partitionBy(*keys, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside", F.coalesce(F.sum("m").over(within), F.lit(0))).join(sums, [*keys, "part"])
    placed = placed.select(*keys, "x", "n", (F.col("before") + F.col("inside")).alias("low"), (F.col("before") + F.col("inside") + F.col("m")).alias("high"))
    # a value is at the ranks low .. high - 1; each quantile lies between the ranks floor and floor + 1 of its place
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])

    def at(p):
        place = p * (F.col("n") - 1)
        below = F.floor(place)
        rest = place - below
        weight = F.when((below >= F.col("low")) & (below < F.col("high")), 1 - rest).otherwise(0.0)
        above = F.least(below + 1, F.col("n") - 1)
        return weight + F.when((above >= F.col("low")) & (above < F.col("high")), rest).otherwise(0.0)

    least = min(probabilities, default=0.0)
    shares = placed.where(F.col("high") > F.floor(F.lit(least) * (F.col("n") - 1))).select(*keys, "x", "n", F.posexplode(F.transform(wanted, at)).alias("i", "w")).where("w > 0")
    found = shares.groupBy(*keys, "n", "i").agg(F.sum(F.col("x") * F.col("w")).alias("q"))
    return found.groupBy(*keys, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "q"))), lambda s: s["q"]).alias("quantiles"))
