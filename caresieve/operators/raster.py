"""Masks as rasters: connected components in blocks, metrics on what they give, patches and their labels."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.operators import images
from caresieve.operators.graph import components as graph_components
from caresieve.operators.graph import joined
from caresieve.operators.skew import cut, salted_join
from caresieve.session import ship

#: Slices and rows of a block that one task labels.
BLOCK_SLICES, BLOCK_ROWS = 32, 256


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, end) of the runs of equal values that aren't 0, in order; values: (rows, columns)."""
    edge = np.ones((len(values), values.shape[1] + 1), bool)
    edge[:, 1:-1] = values[:, 1:] != values[:, :-1]
    row, first = np.nonzero(edge[:, :-1])
    _, end = np.nonzero(edge[:, 1:])
    keep = values[row, first] != 0
    return row[keep], first[keep], end[keep] + 1


def _touching(row, first, end, step: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs, the second `step` rows after the first, that share a column."""
    low = np.searchsorted(row * width + end, (row + step) * width + first, "right")
    high = np.searchsorted(row * width + first, (row + step) * width + end, "left")
    n = np.maximum(0, high - low)
    a = np.repeat(np.arange(len(row)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def _label(z: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place in z, row, first, end, component) of the runs of one block; values: (slices, rows, columns), component: the place of its first run."""
    depth, h, w = values.shape
    # a row between slices keeps rows of different slices apart, and slices that aren't neighbours have as many as are missing between them
    at = (z - z[0]) if len(z) else z
    row, first, end = _runs(values.reshape(depth * h, w))
    k, y = row // h, row % h
    line = at[k] * (h + 1) + y
    value, root = values.reshape(depth * h, w)[row, first], np.arange(len(row))
    for step in (1, h + 1):
        a, b = _touching(line, first, end, step, w + 1)
        same = value[a] == value[b]
        root = joined(root, a[same], b[same])
    return k, y, first, end, root


def connected_components(slices: DataFrame, keys: list[str], values: str = "pixels", index: str = "slice_idx", block: tuple[int, int] = (BLOCK_SLICES, BLOCK_ROWS)) -> DataFrame:
    """(keys, slice_idx, row, column, length, value, label) of runs of voxels: equal values that touch by a face have one label.

    slices: (keys, slice_idx, h, w, values); 0 and null are background. The label is 1 + the place of
    the component's first voxel in the volume, in order of slices, rows and columns. Missing slices part what lies on both
    sides. Each block of slices and rows is labelled by itself in one task; runs at the
    borders of blocks that touch are links of a graph, whose components unite the blocks'
    labels, so no task holds a volume, and a component may be of any size. Slices of a
    volume must be alike in size.
    """
    depth, band = block
    schema = slices.schema
    known = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in keys)
    n_bands = F.ceil(F.col("h") / band)
    part = F.explode(F.sequence(F.lit(0), (n_bands - 1).cast("int")))
    rows = slices.where((F.col("h") > 0) & (F.col("w") > 0)).select(*keys, F.col(index).cast("int").alias("z"), "h", "w", F.col(values).alias("x"), part.alias("part"))
    own = F.transform(F.slice("x", F.col("part") * band * F.col("w") + 1, (F.least(F.lit(band), F.col("h") - F.col("part") * band) * F.col("w")).cast("int")), lambda v: F.coalesce(v.cast("double"), F.lit(0.0)))
    blocks = rows.select(*keys, F.floor(F.col("z") / depth).cast("int").alias("slab"), "part", "z", "h", "w", own.alias("x"))

    def label(table: pa.Table) -> pa.Table:
        table = table.sort_by("z")
        w, h, first_row = table.column("w")[0].as_py(), table.column("h")[0].as_py(), table.column("part")[0].as_py() * band
        z = table.column("z").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(z), -1, w)
        k, y, first, end, root = _label(z, x)
        place = (z[k].astype(np.int64) * h + first_row + y) * w + first
        one = table.slice(0, 1).select(keys)
        many = one.take(pa.array(np.zeros(len(k), np.int64)))
        own = {"slice_idx": z[k].astype(np.int32), "row": (first_row + y).astype(np.int32), "column": first.astype(np.int32), "length": (end - first).astype(np.int32), "value": x[k, y, first], "at": place[root] + 1}
        edge = (y == 0) & (first_row > 0) | (y == x.shape[1] - 1) | (z[k] % depth == 0) | (z[k] % depth == depth - 1)
        return pa.table({**{c: many.column(c) for c in keys}, **{c: pa.array(v) for c, v in own.items()}, "part": pa.array(np.full(len(k), first_row // band, np.int32)), "edge": pa.array(edge)})

    ship(slices.sparkSession)
    found = blocks.groupBy(*keys, "slab", "part").applyInArrow(label, f"{known}, slice_idx int, row int, column int, length int, value double, at bigint, part int, edge boolean")
    runs = cut(found.withColumn("node", F.struct(*keys, "at")))
    border = runs.where("edge").select(F.struct(*keys).alias("volume"), "slice_idx", "row", "column", "length", "value", "node")
    links = None
    for z, y in ((0, 1), (1, 0)):
        above, below = border.alias("a"), border.alias("b")
        # equal rows of neighbouring slices, or neighbouring rows: of those only the ones at the edge of a block
        crosses = F.col("b.row") % band == 0 if y else F.col("b.slice_idx") % depth == 0
        touch = (F.col("a.column") < F.col("b.column") + F.col("b.length")) & (F.col("b.column") < F.col("a.column") + F.col("a.length")) & (F.col("a.value") == F.col("b.value"))
        pairs = above.join(below, F.col("a.volume").eqNullSafe(F.col("b.volume")) & (F.col("a.slice_idx") + z == F.col("b.slice_idx")) & (F.col("a.row") + y == F.col("b.row")) & touch & crosses)
        pairs = pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
        links = pairs if links is None else links.unionByName(pairs)
    roots = graph_components(links).select("node", F.col("root.at").alias("label"))
    moved = cut(runs.groupBy("node").agg(F.count(F.lit(1)).alias("n")).join(roots, "node"))
    columns = [*keys, "slice_idx", "row", "column", "length", "value"]
    # most labels aren't moved; those that are may have very many runs
    still = runs.join(moved.select("node"), "node", "left_anti").select(*columns, F.col("at").alias("label"))
    return still.unionByName(salted_join(runs.select("node", *columns), moved, ["node"], "n", "row").select(*columns, "label"))


def paint(slices: DataFrame, runs: DataFrame, keys: list[str], index: str = "slice_idx", column: str = "label") -> DataFrame:
    """slices with `label`, an array of the runs' labels by pixel, 0 where there is none; a slice's runs meet in one task."""
    own = runs.groupBy(*keys, F.col("slice_idx").alias(index)).agg(F.collect_list(F.struct((F.col("row")).alias("y"), F.col("column").alias("x"), F.col("length").alias("n"), F.col(column).cast("bigint").alias("v"))).alias("__runs"))
    ship(slices.sparkSession)

    @F.pandas_udf("array<bigint>")
    def painted(h, w, found):
        import pandas as pd

        def one(a, b, rs):
            out = np.zeros((a, b), np.int64)
            for r in rs if rs is not None else ():
                out[r["y"], r["x"] : r["x"] + r["n"]] = r["v"]
            return out.ravel()

        return pd.Series([one(*v) for v in zip(h, w, found)])

    return slices.join(own, [*keys, index], "left").withColumn("label", painted("h", "w", "__runs")).drop("__runs")


def labelled(slices: DataFrame, keys: list[str], mask: Column, name: str, index: str = "slice_idx") -> DataFrame:
    """slices with the components of a mask, an array of 0 and 1 by pixel, as the array column `name`."""
    held = cut(slices.withColumn("__mask", mask))
    runs = connected_components(held.select(*keys, index, "h", "w", "__mask"), keys, "__mask", index)
    return paint(held, runs, keys, index).withColumnRenamed("label", name).drop("__mask")


def above(values: str, threshold: float) -> Column:
    """1 where a value is over the threshold, else 0."""
    return F.transform(values, lambda v: (v > threshold).cast("int"))


def inside(values: str, threshold: float) -> Column:
    """1 where a boundary probability isn't over the threshold, else 0: what boundaries enclose."""
    return F.transform(values, lambda v: (~(v > threshold)).cast("int"))


def likeliest(channels: list[str]) -> Column:
    """The number, from 0, of the channel with the largest value at each pixel, of equal ones the first."""
    rows = F.arrays_zip(*[F.col(c) for c in channels])
    return F.transform(rows, lambda r: F.array_position(F.array(*[r[c] for c in channels]), F.greatest(*[r[c] for c in channels])).cast("int") - 1)


def voxels(slices: DataFrame, keys: list[str], **columns: str) -> DataFrame:
    """A row a pixel with the values of several array columns under new names."""
    zipped = F.arrays_zip(*[F.col(c).alias(n) for n, c in columns.items()])
    return slices.select(*keys, F.inline(zipped)).toDF(*keys, *columns)


def boundary_rand_error(slices: DataFrame, keys: list[str], truth: str, boundary: str, threshold: float = 0.4, invert: bool = True) -> DataFrame:
    """error, precision and recall of the adapted Rand index: what a boundary prediction encloses against true labels.

    Without `invert` the prediction is of insides: what is over the threshold is a segment.
    """
    found = labelled(slices, keys, inside(boundary, threshold) if invert else above(boundary, threshold), "__found")
    return images.adapted_rand(voxels(found, [], t=truth, p="__found"), "t", "p")


def boundary_average_precision(slices: DataFrame, keys: list[str], truth: str, channels: list[str], threshold: float = 0.4, ignore: int = -1, least: int | None = None) -> DataFrame:
    """(keys, average_precision): of the boundary channels the best one's."""
    found = None
    for c in channels:
        one = labelled(slices, keys, inside(c, threshold), "__found")
        score = images.average_precision(voxels(one, keys, t=truth, p="__found"), "t", "p", ignore, least, keys)
        found = score if found is None else found.unionByName(score)
    return found.groupBy(*keys).agg(F.max("average_precision").alias("average_precision"))


def distance_average_precision(slices: DataFrame, keys: list[str], truth: str | Column, predicted: str | Column, threshold: float = 0.1) -> DataFrame:
    """(keys, average_precision) of the components over a threshold of two distance transforms; levels (as `likeliest` gives them) count alike."""
    held = slices.withColumn("__truth", F.col(truth) if isinstance(truth, str) else truth).withColumn("__predicted", F.col(predicted) if isinstance(predicted, str) else predicted)
    both = labelled(labelled(held, keys, above("__truth", threshold), "__t"), keys, above("__predicted", threshold), "__p")
    return images.average_precision(voxels(both, keys, t="__t", p="__p"), "t", "p", by=keys)


# ---- patches


def _starts(n: Column, size: int, stride: int) -> Column:
    """Where patches begin along an axis: every stride, and so that the last one ends with the axis."""
    last = F.greatest(n - size, F.lit(0))
    return F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last)))


def split(slices: DataFrame, keys: list[str], patch: tuple[int, int, int], stride: tuple[int, int, int], values: str = "pixels", index: str = "slice_idx") -> DataFrame:
    """(keys, z, y, x, depth, height, width, n_slices, h, w, slice_idx, tile): one tile a slice of each patch.

    A patch begins at slice z, row y, column x; its tiles are the rows of equal z, y and x.
    Neighbours overlap where the stride is smaller than the patch. Volumes smaller than a
    patch give one of their own size. Slices count from 0 without gaps.
    """
    n = slices.groupBy(*keys).agg((F.max(index) + 1).cast("int").alias("n_slices"))
    d, a, b = (F.least(F.lit(size), F.col(c)) for size, c in zip(patch, ("n_slices", "h", "w")))
    rows = slices.select(*keys, index, "h", "w", F.col(values).alias("__x")).join(n, keys)
    rows = rows.select("*", F.explode(_starts(F.col("n_slices"), patch[0], stride[0])).alias("z")).where((F.col(index) >= F.col("z")) & (F.col(index) < F.col("z") + patch[0]))
    rows = rows.select("*", F.explode(_starts(F.col("h"), patch[1], stride[1])).alias("y")).select("*", F.explode(_starts(F.col("w"), patch[2], stride[2])).alias("x"))
    tile = F.flatten(F.transform(F.sequence(F.lit(0), a - 1), lambda i: F.slice("__x", (F.col("y") + i) * F.col("w") + F.col("x") + 1, b)))
    return rows.select(*keys, "z", "y", "x", d.alias("depth"), a.alias("height"), b.alias("width"), "n_slices", "h", "w", F.col(index).alias("slice_idx"), tile.alias("tile"))


def unpad(tiles: DataFrame, pad: int) -> DataFrame:
    """Patches without `pad` voxels at each side that isn't a side of the volume."""
    low = {c: F.when(F.col(c) > 0, F.lit(pad)).otherwise(0) for c in ("z", "y", "x")}
    high = {c: F.when(F.col(c) + F.col(size) < F.col(n), F.lit(pad)).otherwise(0) for c, size, n in (("z", "depth", "n_slices"), ("y", "height", "h"), ("x", "width", "w"))}
    kept = tiles.where((F.col("slice_idx") >= F.col("z") + low["z"]) & (F.col("slice_idx") < F.col("z") + F.col("depth") - high["z"]))
    rows = F.sequence(low["y"], F.col("height") - high["y"] - 1)
    tile = F.flatten(F.transform(rows, lambda i: F.slice("tile", i * F.col("width") + low["x"] + 1, F.col("width") - low["x"] - high["x"])))
    new = {"z": F.col("z") + low["z"], "y": F.col("y") + low["y"], "x": F.col("x") + low["x"], "depth": F.col("depth") - low["z"] - high["z"], "height": F.col("height") - low["y"] - high["y"], "width": F.col("width") - low["x"] - high["x"]}
    # the tile first, as a name in a lambda is taken for the new column of that name beside it
    return kept.withColumn("tile", tile).select(*[new[c].alias(c) if c in new else F.col(c) for c in tiles.columns])


def stitch(tiles: DataFrame, keys: list[str], how: str = "mean") -> DataFrame:
    """(keys, slice_idx, h, w, pixels) from patches: the mean of the patches that cover a voxel, or with how = 'first' that of the first by z, y, x; null where none does.

    The tiles of one slice meet in a task.
    """
    known = ", ".join(f"`{k}` {tiles.schema[k].dataType.simpleString()}" for k in keys)

    def join(table: pa.Table) -> pa.Table:
        order = [("z", "ascending"), ("y", "ascending"), ("x", "ascending")]
        table = table.sort_by(order)
        one = table.slice(0, 1)
        h, w = one.column("h")[0].as_py(), one.column("w")[0].as_py()
        total, n = np.zeros((h, w)), np.zeros((h, w), np.int64)
        for y, x, a, b, tile in zip(*(table.column(c) for c in ("y", "x", "height", "width", "tile"))):
            y, x, a, b = y.as_py(), x.as_py(), a.as_py(), b.as_py()
            own = tile.values.to_numpy(zero_copy_only=False).reshape(a, b)
            new = n[y : y + a, x : x + b] == 0 if how == "first" else np.ones((a, b), bool)
            total[y : y + a, x : x + b] += np.where(new, own, 0)
            n[y : y + a, x : x + b] += new
        values = pa.array(np.where(n, total / np.maximum(n, 1), 0).ravel(), mask=(n == 0).ravel())
        pixels = pa.ListArray.from_arrays(pa.array([0, h * w], pa.int32()), values)
        return pa.table({**{k: one.column(k) for k in keys}, "slice_idx": one.column("slice_idx"), "h": one.column("h"), "w": one.column("w"), "pixels": pixels})

    ship(tiles.sparkSession)
    tiles = tiles.withColumn("tile", F.transform("tile", lambda v: v.cast("double")))
    return tiles.groupBy(*keys, "slice_idx").applyInArrow(join, f"{known}, slice_idx int, h int, w int, pixels array<double>")


def each_patch(tiles: DataFrame, keys: list[str], function: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """tiles whose patches went through a function of (depth, height, width) arrays that keeps their size; a task holds one patch."""
    columns = tiles.columns
    schema = ", ".join(f"`{f.name}` {'array<double>' if f.name == 'tile' else f.dataType.simpleString()}" for f in tiles.schema.fields)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice_idx")
        a, b = table.column("height")[0].as_py(), table.column("width")[0].as_py()
        x = table.column("tile").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), a, b)
        out = np.asarray(function(x), float).reshape(len(table), -1)
        return table.set_column(columns.index("tile"), "tile", pa.array(list(out), pa.list_(pa.float64())))

    ship(tiles.sparkSession)
    return tiles.groupBy(*keys, "z", "y", "x").applyInArrow(run, schema)


def merge_patch_labels(tiles: DataFrame, keys: list[str], least: float = 0.7, noise: int | None = None) -> DataFrame:
    """(keys, slice_idx, h, w, pixels) with one label for what patches labelled apart.

    Labels of two patches are one where their intersection over union, in the voxels
    that both patches cover, is `least` or more; so are those that a chain of such
    pairs joins. Labels come from a graph of overlaps and not from the order of
    patches: a label is 1 + the place of the first one united in it, among (patch,
    label) of the volume. A voxel takes its label from the first patch with one. 0 is background, as is `noise`.
    """
    patch = F.struct("z", "y", "x")
    line = F.posexplode("tile").alias("at", "label")
    cells = tiles.select(*keys, "slice_idx", patch.alias("patch"), "y", "x", "width", line).select(
        *keys, "slice_idx", "patch", (F.col("y") + F.floor(F.col("at") / F.col("width"))).cast("int").alias("row"), (F.col("x") + F.col("at") % F.col("width")).cast("int").alias("column"), F.col("label").cast("bigint").alias("label")
    )
    cells = cells if noise is None else cells.withColumn("label", F.when(F.col("label") == noise, 0).otherwise(F.col("label")))
    volume = F.struct(*keys)
    cells = cut(cells.select(volume.alias("volume"), "slice_idx", "row", "column", "patch", "label"))
    # a voxel is covered by a few patches: those of the overlap
    stack = F.array_sort(F.collect_list(F.struct("patch", "label")))
    covered = cells.groupBy("volume", "slice_idx", "row", "column").agg(stack.alias("s")).where(F.size("s") > 1)
    pairs = covered.select("volume", F.explode("s").alias("a"), "s").select("volume", "a", F.explode("s").alias("b")).where("a.patch < b.patch")
    met = cut(pairs.groupBy("volume", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    size = lambda side: met.where(f"{side}.label <> 0").groupBy("volume", F.col(side).alias("own"), (F.col("b.patch") if side == "a" else F.col("a.patch")).alias("other")).agg(F.sum("n").alias("n_own"))
    sizes = size("a").select("volume", F.col("own").alias("a"), F.col("other").alias("b_patch"), F.col("n_own").alias("n_a")), size("b").select("volume", F.col("own").alias("b"), F.col("other").alias("a_patch"), F.col("n_own").alias("n_b"))
    both = met.where("a.label <> 0 and b.label <> 0").withColumn("b_patch", F.col("b.patch")).withColumn("a_patch", F.col("a.patch"))
    both = both.join(sizes[0], ["volume", "a", "b_patch"]).join(sizes[1], ["volume", "b", "a_patch"])
    same = both.where(F.col("n") >= least * (F.col("n_a") + F.col("n_b") - F.col("n")))
    node = lambda c: F.struct(F.col("volume"), F.col(c)["patch"].alias("patch"), F.col(c)["label"].alias("label"))
    roots = graph_components(same.select(node("a").alias("a"), node("b").alias("b")))
    names = cells.where("label <> 0").groupBy("volume", "patch", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("node", F.struct("volume", "patch", "label"))
    names = names.join(roots, "node", "left").select("volume", "patch", "label", "n", F.coalesce("root", "node").alias("root"))
    firsts = names.groupBy("volume").agg(F.array_sort(F.collect_set("root")).alias("roots"))  # the instances of one volume
    numbered = cut(names.join(firsts.select("volume", F.posexplode("roots").alias("number", "root")), ["volume", "root"]).select("volume", "patch", "label", "n", (F.col("number") + 1).alias("new")))
    renamed = salted_join(cells.where("label <> 0"), numbered, ["volume", "patch", "label"], "n", "row")
    owned = renamed.groupBy("volume", "slice_idx", "row", "column").agg(F.min_by("new", "patch").alias("label"))
    frame = tiles.select(*keys, "slice_idx", "h", "w").distinct()
    runs = owned.select("volume.*", "slice_idx", "row", "column", F.lit(1).alias("length"), "label")
    return paint(frame, runs, keys).withColumnRenamed("label", "pixels")
