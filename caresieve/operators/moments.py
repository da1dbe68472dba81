"""Mergeable first and second moments: computed per site, pooled without the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def local_moments(df: DataFrame, site: str, columns: list[str]) -> DataFrame:
    """One row per site: n and, for each column, mean and population deviation."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"sd_{c}")]
    return df.groupBy(site).agg(*aggs)


def pooled_moments(local: DataFrame, columns: list[str]) -> DataFrame:
    """The pooled mean and deviation from the rows of local_moments alone.

    With N the sum of n: mean = sum(n*m)/N and sd^2 = sum(n*(s^2+m^2))/N - mean^2,
    written around the pooled mean to avoid cancellation.
    """
    total = local.agg(
        F.sum("n").alias("n_all"), *[(F.sum(F.col("n") * F.col(f"mean_{c}")) / F.sum("n")).alias(f"mu_{c}") for c in columns]
    )
    spread = local.crossJoin(F.broadcast(total))
    aggs = [F.max("n_all").alias("n_total")]
    for c in columns:
        second = F.col(f"sd_{c}") ** 2 + (F.col(f"mean_{c}") - F.col(f"mu_{c}")) ** 2
        aggs += [
            F.max(f"mu_{c}").alias(f"mean_{c}"),
            F.sqrt(F.sum(F.col("n") * second) / F.max("n_all")).alias(f"sd_{c}"),
        ]
    return spread.agg(*aggs)
