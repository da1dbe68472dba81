"""Joins on order instead of equality: the latest fact before a moment, and points inside intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caresieve.operators.skew import cut, free_names


def asof_join(rows: DataFrame, facts: DataFrame, by: list[str], at: str, columns: list[str]) -> DataFrame:
    """rows with `columns` of the fact of the same key that is the latest at or before `at`; null where there is none.

    Both sides have `by` and `at`; by may be empty. Of facts of one moment the one whose columns sort
    last is taken. Rows with a null key or moment get no fact, facts with one count for nothing.

    Rows and facts are sorted together by key and moment into ranges, so a key of any
    number of rows is dealt over tasks; what a range ends with is carried over its
    border, through a table of a row for each key and range that it lies in.
    """
    side, fact, part, own = free_names([*rows.columns, *facts.columns], "side", "fact", "part", "own")
    whole = [*by, at]
    known = facts.dropna(subset=whole).select(*whole, F.lit(0).alias(side), F.struct(*columns).alias(fact))
    null = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in whole])
    both = rows.where(~null).withColumn(side, F.lit(1)).unionByName(known, allowMissingColumns=True)
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = cut(both.repartitionByRange(ranges, *whole, side, F.xxhash64(*rows.columns)).withColumn(part, F.spark_partition_id()))  # bounds are sampled: the numbers must stay
    so_far = Window.partitionBy(part, *by).orderBy(F.col(at), F.col(side), F.col(fact)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn(own, F.last(fact, ignorenulls=True).over(so_far)).where(F.col(side) == 1)
    ends = both.groupBy(part, *by).agg(F.max(F.when(F.col(side) == 0, F.struct(at, fact))).alias(own)).select(part, *by, F.col(f"{own}.{fact}").alias(fact))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1) if by else Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn(fact, F.last(fact, ignorenulls=True).over(before)).where(F.col(fact).isNotNull())
    out = found.drop(fact).join(carried, [part, *by], "left")
    taken = F.coalesce(own, fact)
    out = out.select(*rows.columns, *[taken[c].alias(c) for c in columns])
    kinds = dict(facts.dtypes)
    return out.unionByName(rows.where(null).select(*rows.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in columns]))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, width: float) -> DataFrame:
    """Pairs of points and the intervals, low <= at < high, that hold them.

    An interval is copied to each stretch of `width` that it touches and a point goes to
    its own, so they meet by equality. Choose a width near the usual length of an
    interval: a longer one is copied length / width times.
    """
    stretch = free_names([*points.columns, *intervals.columns], "stretch")[0]
    own = points.withColumn(stretch, F.floor(F.col(at) / width).cast("long"))
    first, last = F.floor(F.col(low) / width).cast("long"), F.floor(F.col(high) / width).cast("long")
    spread = intervals.where(F.col(low) < F.col(high)).withColumn(stretch, F.explode(F.sequence(first, last)))
    return own.join(spread, stretch).where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop(stretch)
