"""Array functions on pixel rows, in built-in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value), value being computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def mean(x: Column) -> Column:
    return total(x) / F.size(x)


def deviation(x: Column) -> Column:
    """Population standard deviation."""
    return let(mean(x), lambda m: F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)) / F.size(x)))


def clip(x: Column, low: Column, high: Column) -> Column:
    return F.transform(x, lambda v: F.least(F.greatest(v, low), high))


def percentile(x: Column, q: float) -> Column:
    """Linear interpolation between order statistics, q in 0 to 1."""

    def at(s: Column) -> Column:
        place = (F.size(s) - 1) * F.lit(float(q))
        below = F.floor(place).cast("int")
        low = F.element_at(s, below + 1)
        high = F.element_at(s, F.least(below + 2, F.size(s)))
        return low + (high - low) * (place - below)

    return F.when(F.size(x) > 0, let(F.sort_array(x), at))


def clip_percentiles(x: Column, low: float, high: float) -> Column:
    return let(F.array(percentile(x, low), percentile(x, high)), lambda b: clip(x, b[0], b[1]))


def min_max(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Scaled to a range; null for a constant row, which is discarded."""
    span = F.array_max(x) - F.array_min(x)
    return F.when(
        span > 0,
        let(F.array(F.array_min(x), span), lambda b: F.transform(x, lambda v: (v - b[0]) / b[1] * (high - low) + low)),
    )


def standardised(x: Column) -> Column:
    """Mean 0 and deviation 1; null for a constant row, which is discarded."""
    return F.when(
        F.array_max(x) > F.array_min(x),
        let(F.array(mean(x), deviation(x)), lambda b: F.transform(x, lambda v: (v - b[0]) / b[1])),
    )


def inverted(x: Column) -> Column:
    """Largest value minus each: MONOCHROME1 as MONOCHROME2."""
    return let(F.array_max(x), lambda top: F.transform(x, lambda v: top - v))


def hounsfield(x: Column, slope: Column, intercept: Column, low: float, high: float) -> Column:
    return F.transform(x, lambda v: F.least(F.greatest(v * slope + intercept, F.lit(float(low))), F.lit(float(high))))


def correlation(x: Column, y: Column) -> Column:
    """Normalised cross-correlation of two rows; null if either is constant."""

    def of(m: Column) -> Column:
        pairs = F.arrays_zip(x.alias("a"), y.alias("b"))
        zero = F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy"))

        def step(s: Column, p: Column) -> Column:
            a, b = p["a"] - m[0], p["b"] - m[1]
            return F.struct((s["xy"] + a * b).alias("xy"), (s["xx"] + a * a).alias("xx"), (s["yy"] + b * b).alias("yy"))

        return F.aggregate(pairs, zero, step, lambda s: F.when(s["xx"] * s["yy"] > 0, s["xy"] / F.sqrt(s["xx"] * s["yy"])))

    return let(F.array(mean(x), mean(y)), of)


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def angle(x: Column, y: Column) -> Column:
    """Radians between two directions, each scaled to just under a unit so that the cosine stays in bounds."""

    def unit(v: Column) -> Column:
        return let(F.greatest(F.sqrt(dot(v, v)), F.lit(1e-8)), lambda n: F.transform(v, lambda z: z / n * 0.999999))

    return F.acos(dot(unit(x), unit(y)))


def squared_distance(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def mapped(x: Column, codes: list[int]) -> Column:
    """Sorted distinct values replaced by the sorted codes in their order."""
    table = F.array(*[F.lit(c) for c in sorted(codes)])
    return let(F.array_sort(F.array_distinct(x)), lambda s: F.transform(x, lambda v: F.element_at(table, F.array_position(s, v).cast("int"))))


def doubles(c: Column) -> Column:
    return F.transform(c, lambda v: v.cast("double"))
