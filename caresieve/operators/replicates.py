"""Near-equal feature vectors: exact pairs within a distance by grid cells, and their groups."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.functions.arrays import doubles, squared_distance
from caresieve.operators.graph import components
from caresieve.operators.skew import cut, salted_join
from caresieve.session import ship

#: Projections that make the grid: vectors within the distance lie in neighbouring cells of each.
GRID_AXES = 3
DISTANCE = 1e-3
SEED = 11
#: Width of a cell of linked points, in distances; points of a cell that a task compares; projections that cells are cut by.
CELL, FULL_CELL, MOST_AXES = 8, 1 << 14, 12


def _projection(vector: Column, axis: int) -> Column:
    """The vector along a seeded unit direction of its own length, so no two vectors are farther apart there than in full.

    Every coordinate takes part, so vectors that agree in some of them (black corners
    of images) still fall in different cells.
    """

    def weight(i: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED + axis), i), F.lit(1 << 20)) / F.lit(float(1 << 19)) - 1.0

    along = F.aggregate(F.transform(vector, lambda v, i: v * weight(i)), F.lit(0.0), lambda s, v: s + v)
    norm = F.aggregate(F.transform(vector, lambda v, i: weight(i) * weight(i)), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(along, F.sqrt(norm)), F.lit(0.0))


def distinct_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vector hash class) key, rep: each row with the smallest key among equal vectors, and the vector of that one."""
    return df.groupBy(F.col(vector).alias("v")).agg(F.min(key).alias("rep"), F.count(F.lit(1)).alias("n"))


def close_pairs(df: DataFrame, key: str, vector: str, distance: float = DISTANCE, axes: int = GRID_AXES) -> DataFrame:
    """(a, b, distance), a < b, of the representatives of different vectors nearer than `distance`.

    Equal vectors are one representative, so a group of copies makes no pairs. Cells
    are as wide as the distance (and a hair more, for rounding), so the 3 ** axes
    neighbours hold every partner. Only keys are copied to neighbours; a vector moves
    to the pairs of which it is part.
    """
    points = distinct_vectors(df.select(F.col(key).alias("k"), doubles(F.col(vector)).alias("x")), "k", "x").select(F.col("rep").alias("k"), F.col("v").alias("x"))
    width = distance * (1 + 1e-6)
    cells = [F.floor(_projection(F.col("x"), i) / width).alias(f"c{i}") for i in range(axes)]
    points = cut(points.select("k", "x", *cells))
    own = points.select(F.col("k").alias("a"), *[f"c{i}" for i in range(axes)])
    shifts = F.array(*[F.struct(*[F.lit(s).alias(f"s{i}") for i, s in enumerate(shift)]) for shift in product((-1, 0, 1), repeat=axes)])
    near = points.select(F.col("k").alias("b"), *[f"c{i}" for i in range(axes)], F.explode(shifts).alias("s"))
    near = near.select("b", *[(F.col(f"c{i}") + F.col(f"s.s{i}")).alias(f"c{i}") for i in range(axes)])
    found = own.join(near, [f"c{i}" for i in range(axes)]).where("a < b").select("a", "b").distinct()  # a key of several vectors meets another once
    found = found.join(points.select(F.col("k").alias("a"), F.col("x").alias("xa")), "a").join(points.select(F.col("k").alias("b"), F.col("x").alias("xb")), "b")
    d2 = squared_distance(F.col("xa"), F.col("xb"))
    return found.withColumn("d2", d2).where(F.col("d2") < distance * distance).select("a", "b", F.sqrt("d2").alias("distance"))


def _cells(value: Column, width: float, reach: float) -> Column:
    """The one or two cells of an axis that hold a point or lie within `reach` of it."""
    return F.array_distinct(F.array(F.floor((value - reach) / width), F.floor((value + reach) / width)))


def _forest(x: np.ndarray, distance: float) -> list[tuple[int, int]]:
    """Links that join the vectors nearer than `distance` into the same sets as all their pairs."""
    left, out = np.arange(len(x)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            gap = x[left] - x[i]
            near = np.einsum("ij,ij->i", gap, gap) < distance * distance
            found = left[near].tolist()
            out += [(i, j) for j in found]
            queue += found
            left = left[~near]
    return out


def close_links(points: DataFrame, distance: float = DISTANCE, axes: int = GRID_AXES) -> DataFrame:
    """Links (a, b) that join points (k, x) into the same sets as all pairs nearer than `distance`, at most one a point and cell.

    Points meet in cells of CELL times the distance along `axes` seeded projections, and in the next ones
    where they lie that near to a border. Cells of over FULL_CELL points are cut along
    `axes` further projections, at most MOST_AXES of them; a task holds one cell.
    """
    kind = dict(points.dtypes)["k"]
    rows, out, first = points.select("k", "x", F.lit("").alias("cell")), None, 0
    reach = distance * (1 + 1e-6)

    def run(batches):
        held: list[tuple] = []
        now = None

        def links():
            if len(held) < 2:
                return pa.RecordBatch.from_arrays([pa.array([], keys), pa.array([], keys)], ["a", "b"])
            found = _forest(np.stack([h[1] for h in held]), distance)
            return pa.RecordBatch.from_arrays([pa.array([held[i][0] for i, _ in found], keys), pa.array([held[j][0] for _, j in found], keys)], ["a", "b"])

        keys = None
        for batch in batches:
            keys = batch.column("k").type
            for cell, k, x in zip(batch.column("cell").to_pylist(), batch.column("k").to_pylist(), batch.column("x")):
                if cell != now:
                    if len(held) > 1:
                        yield links()
                    held, now = [], cell
                held.append((k, x.values.to_numpy(zero_copy_only=False)))
        if len(held) > 1:
            yield links()

    ship(points.sparkSession)
    while True:
        sides = [_cells(_projection(F.col("x"), first + i), CELL * distance, reach) for i in range(axes)]
        rows = rows.select("k", "x", "cell", *[s.alias(f"s{i}") for i, s in enumerate(sides)])
        for i in range(axes):
            rows = rows.withColumn(f"s{i}", F.explode(f"s{i}"))
        rows = cut(rows.select("k", "x", F.md5(F.concat_ws(",", "cell", *[f"s{i}" for i in range(axes)])).alias("cell")))
        first += axes
        full = cut(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FULL_CELL).select("cell")) if first < MOST_AXES else None
        more = full is not None and not full.isEmpty()
        done = rows.join(full, "cell", "left_anti") if more else rows
        found = done.repartition("cell").sortWithinPartitions("cell").select("cell", "k", "x").mapInArrow(run, f"a {kind}, b {kind}")
        out = found if out is None else out.unionByName(found)
        if not more:
            return out
        rows = rows.join(full, "cell", "left_semi")


def replicate_groups(df: DataFrame, key: str, vector: str, distance: float = DISTANCE) -> DataFrame:
    """(key, group_id, kept) of keys in a group of two or more; the smallest key of a group is kept.

    Groups are the connected ones: keys linked by a chain of close pairs are together; no
    pairs are listed. A key that several rows have is one, and joins what any of its vectors is near. Rows meet
    their group by a 128-bit hash of their vector, very frequent ones dealt over tasks, and not by the vector itself.
    """
    x = doubles(F.col(vector))
    rows = cut(df.select(F.col(key).alias("k"), x.alias("x")).select("k", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(7), "x").alias("h2")))
    classes = cut(rows.groupBy("h1", "h2").agg(F.min("k").alias("rep"), F.max("k").alias("last"), F.count(F.lit(1)).alias("n"), F.first("x").alias("x")))
    links = close_links(classes.select(F.col("rep").alias("k"), "x"), distance)
    h = F.struct("h1", "h2")
    repeated = cut(rows.groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.min(h).alias("low"), F.max(h).alias("high")).where("low <> high").select("k", "m"))
    if not repeated.isEmpty():
        twice = salted_join(rows.select("k", "h1", "h2"), repeated, ["k"], "m", "h1").select("k", "h1", "h2")
        links = links.unionByName(salted_join(twice, classes.select("h1", "h2", "n", "rep"), ["h1", "h2"], "n", "k").select(F.col("k").alias("a"), F.col("rep").alias("b")))
    roots = components(links)
    named = classes.join(roots, classes["rep"] == roots["node"], "left").where((F.col("rep") < F.col("last")) | F.col("root").isNotNull())
    named = cut(named.select("h1", "h2", "n", F.coalesce("root", "rep").alias("group_id")))
    members = salted_join(rows.select("k", "h1", "h2"), named, ["h1", "h2"], "n", "k").select("k", "group_id").distinct()
    return members.select(F.col("k").alias(key), "group_id", (F.col("k") == F.col("group_id")).alias("kept"))
