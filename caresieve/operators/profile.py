"""Profile of a table: statistics per column and the most frequent values, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caresieve.operators.quantiles import exact_quantiles

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """variable, type, valid, missing, mean, sd, min, q1, median, q3, max; quartiles are exact, null for texts.

    One aggregation for all but the quartiles, which come by ranks (exact_quantiles).
    """
    kinds = dict(df.dtypes)
    columns = columns or df.columns
    numbers = [c for c in columns if kinds[c] in NUMBERS or kinds[c].startswith("decimal")]
    aggs, rows = [], []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"), F.count(F.lit(1)).alias(f"t{i}")]
        if c in numbers:
            v = x.cast("double")
            aggs += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
        at = lambda k, c=c, i=i: F.col(f"{k}{i}") if c in numbers else F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("variable"), F.lit(kinds[c]).alias("type"), F.col(f"n{i}").alias("valid"), (F.col(f"t{i}") - F.col(f"n{i}")).alias("missing"),
                at("m").alias("mean"), at("s").alias("sd"), at("l").alias("min"), at("h").alias("max"),
            )
        )
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if not numbers:
        return out.select("variable", "type", "valid", "missing", "mean", "sd", "min", *[F.lit(None).cast("double").alias(q) for q in ("q1", "median", "q3")], "max")
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("double").alias("x")) for c in numbers])
    quartiles = exact_quantiles(df.select(F.inline(cells)), ["variable"], "x", [0.25, 0.5, 0.75]).select("variable", "quantiles")
    out = out.join(quartiles, "variable", "left")  # a row a column
    return out.select("variable", "type", "valid", "missing", "mean", "sd", "min", *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q1", "median", "q3"))], "max")


def frequent_values(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """variable, level, n, rank of the k most frequent values of each column; a top-k report."""
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("string").alias("level")) for c in columns])
    counts = df.select(F.inline(cells)).where("level is not null").groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("variable").orderBy(F.desc("n"), "level"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def replicate_statistics(df: DataFrame, key: str) -> DataFrame:
    """unique, replicated and surplus: ids, ids of several rows, rows beyond the first of an id."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("unique_ids"), F.count_if(F.col("n") > 1).alias("replicated_ids"), F.sum(F.col("n") - 1).alias("surplus_rows"))
