"""Checks and transforms over decoded slices and masks, one slice or voxel a row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresieve.functions import arrays as A
from caresieve.operators.quantiles import exact_quantiles
from caresieve.operators.skew import free_names
from caresieve.session import ship


def orientation(cosines: Column) -> Column:
    """Axial, Sagittal, Coronal or Unknown by the largest part of the normal of row and column cosines."""
    c = [F.element_at(cosines, i + 1) for i in range(6)]
    n = [F.abs(c[1] * c[5] - c[2] * c[4]), F.abs(c[2] * c[3] - c[0] * c[5]), F.abs(c[0] * c[4] - c[1] * c[3])]
    return (
        F.when((n[2] > n[0]) & (n[2] > n[1]), "Axial").when((n[0] > n[1]) & (n[0] > n[2]), "Sagittal").when((n[1] > n[0]) & (n[1] > n[2]), "Coronal").otherwise("Unknown")
    )


def plane_faults(slices: DataFrame, keys: list[str], cosines: str = "cosines") -> DataFrame:
    """E3301 of volumes: (code, keys, plane) of slices that aren't axial; without cosines the plane is Unknown."""
    plane = F.coalesce(orientation(F.col(cosines)), F.lit("Unknown"))
    return slices.select(F.lit("E3301").alias("code"), *keys, plane.alias("plane")).where("plane <> 'Axial'")


def view_faults(images: DataFrame, keys: list[str], orientation_: str, view: str, patient_column: str = "patient_orientation", view_column: str = "view_position") -> DataFrame:
    """(code, keys) of flat images: E3301 where orientation or view isn't the protocol's, W3301 where either isn't given."""
    a, b = (F.nullif(F.trim(F.col(c)), F.lit("")) for c in (patient_column, view_column))
    code = F.when(a.isNull() | b.isNull(), "W3301").when((a != orientation_) | (b != view), "E3301")
    return images.select(code.alias("code"), *keys).where("code is not null")


def slice_checks(slices: DataFrame, min_height: int, min_width: int, modality: str | None = None) -> DataFrame:
    """code, patient_id, series_id, slice_idx of failing slices: E3101 modality, E3201 size, E3401 uniform, E3501 small.

    The size is frames * h * w * samples values, or, with a column n_bytes, that times
    bits / 8 bytes; frames and samples are 1 where there is no such column, and slices
    whose column `compressed` is true have no size to check. Other absent columns and
    missing metadata fail nothing.
    """

    def has(name, default):
        return F.coalesce(F.col(name), F.lit(default)) if name in slices.columns else F.lit(default)

    values = F.col("h") * F.col("w") * has("frames", 1) * has("samples", 1)
    wrong_size = F.col("n_bytes") != F.floor(values * has("bits", 8) / 8) if "n_bytes" in slices.columns else F.size("pixels") != values
    tests = [("E3401", F.array_max("pixels") == F.array_min("pixels")), ("E3501", (F.col("h") < min_height) | (F.col("w") < min_width)), ("E3201", wrong_size & ~has("compressed", False))]
    if modality and "modality" in slices.columns:
        tests.append(("E3101", F.col("modality") != {"MRI": "MR"}.get(modality, modality)))
    bad = F.array_compact(F.array(*[F.when(t, F.lit(c)) for c, t in tests]))
    return slices.select(F.explode(bad).alias("code"), "patient_id", "series_id", "slice_idx")


def order_slices(slices: DataFrame, series: list[str], z: str = "z") -> DataFrame:
    """slices with place (from 1, by z) and reordered: whether the series' own order wasn't that of z."""
    by = Window.partitionBy(*series)
    out = slices.withColumn("place", F.row_number().over(by.orderBy(z, "slice_idx")))
    back = F.lag(z).over(by.orderBy("slice_idx")) > F.col(z)
    return out.withColumn("__back", back).withColumn("reordered", F.coalesce(F.bool_or("__back").over(by), F.lit(False))).drop("__back")


def normalise(slices: DataFrame, modality: str, how: str = "minmax", low: float = 0.0, high: float = 1.0, hu: tuple[float, float] = (-1000.0, 1000.0), contrast: bool = False) -> DataFrame:
    """pixels clipped as the modality asks, then scaled or standardised; constant slices have discarded true.

    CT: Hounsfield units clipped to `hu`; MRI: percentiles 0.1 and 99.9; others: 1 and
    99, and with `contrast` equalised by tiles after it.
    """
    x = A.doubles(F.col("pixels"))
    if modality == "CT":
        x = A.hounsfield(x, F.coalesce("slope", F.lit(1.0)), F.coalesce("intercept", F.lit(-1024.0)), *hu)
    else:
        cut = 0.001 if modality == "MRI" else 0.01
        x = A.clip_percentiles(x, cut, 1 - cut)
    if contrast and modality not in ("CT", "MRI"):
        slices = clahe(slices.withColumn("pixels", x))
        x = F.col("pixels")
    done = A.let(x, lambda v: A.min_max(v, low, high) if how == "minmax" else A.standardised(v))
    return slices.withColumn("pixels", done).withColumn("discarded", F.col("pixels").isNull())


def adjacent_correlation(slices: DataFrame, series: list[str], order: str, pixels: str = "pixels") -> DataFrame:
    """W3701: correlation of each slice with the next of its series; null for the last."""
    following = F.lead(pixels).over(Window.partitionBy(*series).orderBy(order))
    return slices.withColumn("__next", following).withColumn("ncc", A.correlation(A.doubles(F.col(pixels)), A.doubles(F.col("__next")))).drop("__next")


#: Correlations of neighbouring slices under these are unexpected.
ALIGNED = {"CT": 0.9, "MRI": 0.8}


def alignment(slices: DataFrame, series: list[str], order: str, modality: str, pixels: str = "pixels") -> DataFrame:
    """W3701: (series..., n_unexpected, mean_ncc, median_ncc, sd_ncc, flagged) of series; pairs with a constant slice have no correlation."""
    pairs = adjacent_correlation(slices, series, order, pixels).where("ncc is not null")
    stats = pairs.groupBy(*series).agg(
        F.count_if(F.col("ncc") < ALIGNED[modality]).alias("n_unexpected"), F.avg("ncc").alias("mean_ncc"), F.median("ncc").alias("median_ncc"), F.stddev_pop("ncc").alias("sd_ncc")
    )
    return stats.withColumn("flagged", F.col("n_unexpected") > 0)


def projection(slices: DataFrame, series: list[str], order: str, pixels: str = "pixels", reach: int = 5) -> DataFrame:
    """Maximum over the middle slice and `reach` to both sides: (series..., pixel, value), pixel from 0.

    Pixels meet by position with partial maxima, not by whole slices.
    """
    by = Window.partitionBy(*series)
    placed = slices.withColumn("__i", F.row_number().over(by.orderBy(order)) - 1).withColumn("__n", F.count(F.lit(1)).over(by))
    middle = placed.where(F.abs(F.col("__i") - F.floor(F.col("__n") / 2)) <= reach)
    return middle.select(*series, F.posexplode(pixels).alias("pixel", "value")).groupBy(*series, "pixel").agg(F.max("value").alias("value"))


def resize_weights(n: int, m: int, smooth: bool = True) -> np.ndarray:
    """(m, n) weights that scale an axis of n pixels to m: a Gaussian against aliasing, then the line between pixel centres.

    The Gaussian's deviation is half of what the axis shrinks by over 1, cut at 4
    deviations; past its ends an axis is mirrored about its last pixels' centres.
    """

    def mirrored(i):
        i = np.abs(i) % max(1, 2 * (n - 1))
        return np.minimum(i, 2 * (n - 1) - i) if n > 1 else np.zeros_like(i)

    at = mirrored((np.arange(m) + 0.5) * n / m - 0.5)
    low = np.floor(at).astype(int)
    line = np.zeros((m, n))
    np.add.at(line, (np.arange(m), low), 1 - (at - low))
    np.add.at(line, (np.arange(m), mirrored(low + 1)), at - low)
    deviation = max(0.0, (n / m - 1) / 2)
    if not smooth or not deviation:
        return line
    reach = np.arange(-int(4 * deviation + 0.5), int(4 * deviation + 0.5) + 1)
    weight = np.exp(-0.5 * (reach / deviation) ** 2)
    blur = np.zeros((n, n))
    np.add.at(blur, (np.repeat(np.arange(n), len(reach)), mirrored(np.arange(n)[:, None] + reach).ravel()), np.tile(weight / weight.sum(), n))
    return line @ blur


def resize(slices: DataFrame, height: int, width: int, nearest: bool = False, smooth: bool = True) -> DataFrame:
    """pixels of each slice as height x width: bilinear, smoothed first along axes that shrink, or the nearest pixel for masks."""

    @F.pandas_udf("array<double>")
    def scaled(pixels, h, w):
        import pandas as pd

        known: dict[tuple[int, int], np.ndarray] = {}

        def weights(n, m):
            if (n, m) not in known:
                known[n, m] = resize_weights(n, m, smooth)
            return known[n, m]

        def one(p, a, b):
            x = np.asarray(p, float).reshape(a, b)
            if nearest:
                y = np.clip((np.arange(height) + 0.5) * a / height - 0.5, 0, a - 1)
                z = np.clip((np.arange(width) + 0.5) * b / width - 0.5, 0, b - 1)
                return x[np.floor(y + 0.5).astype(int)[:, None], np.floor(z + 0.5).astype(int)[None]].ravel()
            return (weights(a, height) @ x @ weights(b, width).T).ravel()

        return pd.Series([None if p is None else one(p, a, b) for p, a, b in zip(pixels, h, w)])

    return slices.withColumn("pixels", scaled("pixels", "h", "w")).withColumns({"h": F.lit(height), "w": F.lit(width)})


#: Tiles a side, and by how much a tile's histogram may exceed an even one.
CLAHE_TILES, CLAHE_CLIP = 8, 2.0


def equalised(image: np.ndarray, tiles: int = CLAHE_TILES, clip: float = CLAHE_CLIP) -> np.ndarray:
    """An 8-bit image with its histogram equalised tile by tile, clipped, and blended between the tiles' centres.

    Where a side isn't divisible by the tiles, both sides are lengthened by mirroring for the
    histograms. What is clipped off is dealt evenly over the 256 levels.
    """
    h, w = image.shape
    more = (0, 0) if h % tiles == 0 and w % tiles == 0 else (tiles - h % tiles, tiles - w % tiles)
    x = np.pad(image, ((0, more[0]), (0, more[1])), "reflect" if min(h, w) > 1 else "edge")
    th, tw = x.shape[0] // tiles, x.shape[1] // tiles
    area = th * tw
    tile = (np.arange(x.shape[0]) // th * tiles)[:, None] + np.arange(x.shape[1]) // tw
    counts = np.bincount((tile * 256 + x).ravel(), minlength=tiles * tiles * 256).reshape(-1, 256)
    limit = max(int(clip * area / 256), 1)
    over = np.maximum(counts - limit, 0).sum(axis=1)
    counts = np.minimum(counts, limit) + (over // 256)[:, None]
    for i in np.flatnonzero(over % 256):
        rest = int(over[i] % 256)
        counts[i, : 256 : max(256 // rest, 1)][:rest] += 1
    table = np.clip(np.rint(np.cumsum(counts, axis=1).astype(np.float32) * np.float32(255 / area)), 0, 255).astype(np.float32).reshape(tiles, tiles, 256)

    def between(n, size):
        at = (np.arange(n, dtype=np.float32) / np.float32(size)) - np.float32(0.5)
        low = np.floor(at).astype(int)
        return np.maximum(low, 0), np.minimum(low + 1, tiles - 1), at - low

    y0, y1, fy = between(h, th)
    x0, x1, fx = between(w, tw)
    y0, y1, fy = y0[:, None], y1[:, None], fy[:, None]
    top = table[y0, x0, image] * (1 - fx) + table[y0, x1, image] * fx
    low = table[y1, x0, image] * (1 - fx) + table[y1, x1, image] * fx
    return np.clip(np.rint(top * (1 - fy) + low * fy), 0, 255).astype(np.uint8)


def clahe(slices: DataFrame, pixels: str = "pixels", tiles: int = CLAHE_TILES, clip: float = CLAHE_CLIP) -> DataFrame:
    """pixels scaled to 0 .. 255 and equalised by tiles; null where all are equal."""

    def one(p, h, w):
        x = np.asarray(p, float).reshape(h, w)
        if not x.size or x.min() == x.max():
            return None
        return equalised(((x - x.min()) / (x.max() - x.min()) * 255).astype(np.uint8), tiles, clip).ravel().astype(float)

    return map_pixels(slices, one, pixels)


def map_pixels(slices: DataFrame, function: Callable, pixels: str = "pixels") -> DataFrame:
    """slices whose pixels went through function(pixels, h, w), a plain array or None; null pixels stay null."""
    names, at = slices.columns, slices.columns.index(pixels)
    schema = ", ".join(f"`{f.name}` {'array<double>' if f.name == pixels else f.dataType.simpleString()}" for f in slices.schema.fields)

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(at), batch.column("h").to_pylist(), batch.column("w").to_pylist())
            done = [function(p.values.to_numpy(zero_copy_only=False), h, w) if p.is_valid else None for p, h, w in rows]
            columns = batch.columns
            columns[at] = pa.array(done, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names)

    ship(slices.sparkSession)
    return slices.mapInArrow(run, schema)


def ssim(a: np.ndarray, b: np.ndarray, span: float, side: int = 7) -> float:
    """Mean structural similarity with a uniform window and sample covariance."""
    from numpy.lib.stride_tricks import sliding_window_view

    def local(x):
        return sliding_window_view(x, (side, side)).mean(axis=(2, 3))

    n = side * side
    ma, mb = local(a), local(b)
    scale = n / (n - 1)
    va, vb, vab = scale * (local(a * a) - ma * ma), scale * (local(b * b) - mb * mb), scale * (local(a * b) - ma * mb)
    c1, c2 = (0.01 * span) ** 2, (0.03 * span) ** 2
    return float((((2 * ma * mb + c1) * (2 * vab + c2)) / ((ma**2 + mb**2 + c1) * (va + vb + c2))).mean())


def series_similarity(slices: DataFrame, series: list[str], order: str, limit: float = 0.005) -> DataFrame:
    """W3602: (series..., sd_ssim, flagged) over the similarities of neighbouring slices; constant pairs are skipped."""

    @F.pandas_udf("double")
    def both(x, y, h, w):
        import pandas as pd

        def one(p, q, a, b):
            if p is None or q is None or len(p) != len(q):
                return None
            p, q = np.asarray(p, float).reshape(a, b), np.asarray(q, float).reshape(a, b)
            span = max(np.ptp(p), np.ptp(q))
            return ssim(p, q, span, min(7, a, b)) if span else None

        return pd.Series([one(*v) for v in zip(x, y, h, w)])

    following = F.lead("pixels").over(Window.partitionBy(*series).orderBy(order))
    rows = slices.withColumn("__next", following).where("__next is not null").select(*series, both("pixels", "__next", "h", "w").alias("s"))
    sd = rows.groupBy(*series).agg(F.stddev_pop("s").alias("sd_ssim"), F.count("s").alias("n")).where("n >= 2")
    return sd.select(*series, "sd_ssim", (F.col("sd_ssim") < limit).alias("flagged"))


def expected_files(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """E005, E2101: keys with problem missing or extra, from an outer join of what should be and what is."""
    a, b = expected.select(*keys).distinct().withColumn("__a", F.lit(1)), actual.select(*keys).distinct().withColumn("__b", F.lit(1))
    both = a.join(b, keys, "full_outer").where("__a is null or __b is null")
    return both.select(*keys, F.when(F.col("__b").isNull(), "missing").otherwise("extra").alias("problem"))


def slice_count_faults(volumes: DataFrame, masks: DataFrame, keys: list[str]) -> DataFrame:
    """E4101, E4801: keys whose volume and mask differ in slices, or of which one is absent."""
    n = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return n(volumes, "n_volume").join(n(masks, "n_mask"), keys, "full_outer").where(~F.col("n_volume").eqNullSafe(F.col("n_mask")))


def label_faults(masks: DataFrame, keys: list[str], label: str, allowed: list[int]) -> DataFrame:
    """E4401: (keys, extra, missing) where the labels of a mask aren't those of the protocol."""
    want = F.array(*[F.lit(x) for x in allowed])
    seen = masks.where(F.col(label) != 0).select(*keys, label).distinct().groupBy(*keys).agg(F.sort_array(F.collect_list(label)).alias("__seen"))
    out = seen.select(*keys, F.array_except("__seen", want).alias("extra"), F.array_except(want, "__seen").alias("missing"))
    return out.where((F.size("extra") > 0) | (F.size("missing") > 0))


def voxel_overlap(voxels: DataFrame, keys: list[str], segment: str, place: list[str]) -> DataFrame:
    """E4601: (keys, segment) of segments that share a voxel with another."""
    by = Window.partitionBy(*keys, *place)
    seen = voxels.select(*keys, *place, segment).distinct().withColumn("__n", F.count(F.lit(1)).over(by))
    return seen.where("__n > 1").select(*keys, segment).distinct()


def merge_labels(voxels: DataFrame, keys: list[str], place: list[str], label: str, order: str) -> DataFrame:
    """One label a voxel: that of the last mask that covers it."""
    return voxels.where(F.col(label) > 0).groupBy(*keys, *place).agg(F.max_by(label, order).alias(label))


def mean_iou(df: DataFrame, truth: str, predicted: str, classes: int, ignore: int | None = None, skip: tuple[int, ...] = ()) -> DataFrame:
    """The mean over the classes 0 .. classes - 1, but for those to skip, of their intersection over union; 0 for one that is nowhere."""
    wanted = [c for c in range(classes) if c not in skip]
    scores = mask_scores(df, truth, predicted, ignore).where(F.col("label").isin(*wanted))
    return scores.agg((F.coalesce(F.sum("iou"), F.lit(0.0)) / len(wanted)).alias("mean_iou"))


def mask_scores(df: DataFrame, truth: str, predicted: str, ignore: int | None = None) -> DataFrame:
    """(label, dice, iou, n_truth, n_predicted) of every label over pixel rows, from one pass.

    Pixels whose truth is `ignore` don't count. Pairs of labels are counted before the shuffle, so it grows with labels and not pixels.
    """
    df = df if ignore is None else df.where(F.col(truth) != ignore)
    cells = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(F.struct(F.col("t").alias("label"), F.col("n").alias("a"), F.lit(0).cast("long").alias("b")), F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("a"), F.col("n").alias("b")))
    both = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    rows = cells.select(F.inline(sides), both.alias("both")).groupBy("label").agg(F.sum("a").alias("n_truth"), F.sum("b").alias("n_predicted"), (F.sum("both") / 2).alias("both"))
    return rows.select(
        "label", (2 * F.col("both") / (F.col("n_truth") + F.col("n_predicted"))).alias("dice"), (F.col("both") / (F.col("n_truth") + F.col("n_predicted") - F.col("both"))).alias("iou"), "n_truth", "n_predicted"
    )


def adapted_rand(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """error, precision, recall from the contingency table; pixels outside the truth (0) don't count."""
    cells = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    n_all = cells.agg(F.sum("n").cast("double").alias("n_all"))
    inside = cells.where("t > 0")
    a = inside.groupBy("t").agg(F.sum("n").cast("double").alias("x")).agg(F.sum(F.col("x") ** 2).alias("sum_a"))
    b = inside.where("p > 0").groupBy("p").agg(F.sum("n").cast("double").alias("x")).agg(F.sum(F.col("x") ** 2).alias("sum_b"))
    ab = inside.agg(F.sum(F.when(F.col("p") > 0, F.col("n").cast("double") ** 2)).alias("sum_ab"), F.sum(F.when(F.col("p") == 0, F.col("n")).otherwise(0)).cast("double").alias("out"))
    one = n_all.crossJoin(a).crossJoin(b).crossJoin(ab)  # four single rows
    extra = F.col("out") / F.col("n_all")
    p = (F.coalesce("sum_ab", F.lit(0.0)) + extra) / F.greatest(F.coalesce("sum_b", F.lit(0.0)) + extra, F.lit(1e-6))
    r = (F.coalesce("sum_ab", F.lit(0.0)) + extra) / F.greatest(F.coalesce("sum_a", F.lit(0.0)), F.lit(1e-6))
    return one.select(p.alias("precision"), r.alias("recall")).select((1 - 2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-6))).alias("error"), "precision", "recall")


#: Overlaps that instances must exceed.
OVERLAPS = (0.5, 0.6, 0.7, 0.8, 0.9)


def average_precision(df: DataFrame, truth: str, predicted: str, ignore: int = -1, least: int | None = None, by: list[str] | None = None, overlaps: tuple[float, ...] = OVERLAPS) -> DataFrame:
    """(by..., average_precision): the area under precision over recall of predicted instances, from pixel rows.

    A predicted instance belongs to the true one with which it shares most pixels (the
    smallest label of equals) and counts where their intersection over union is over
    the limit; one that lies mostly on `ignore` is neither right nor wrong. Instances
    of fewer than `least` pixels are ignored. Each overlap limit gives a point; precision
    is made to fall with recall and integrated as steps. Without instances it is 0.

    Pairs of labels are counted before the shuffle, so it grows with instances.
    """
    by = by or []
    cells = df.groupBy(*by, F.col(truth).alias("__t"), F.col(predicted).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    for side in ("__t", "__p"):
        if least is not None:
            size = F.sum("__n").over(Window.partitionBy(*by, side))
            cells = cells.withColumn("__size", size).withColumn(side, F.when(F.col("__size") < least, ignore).otherwise(F.col(side)))
    cells = cells.groupBy(*by, "__t", "__p").agg(F.sum("__n").alias("__n"))
    cells = cells.withColumns({"__nt": F.sum("__n").over(Window.partitionBy(*by, "__t")), "__np": F.sum("__n").over(Window.partitionBy(*by, "__p"))})
    best = F.row_number().over(Window.partitionBy(*by, "__p").orderBy(F.desc("__n"), "__t"))
    iou = F.col("__n") / (F.col("__nt") + F.col("__np") - F.col("__n"))
    owned = cells.where(F.col("__p") != ignore).withColumn("__r", best).where("__r = 1").select(*by, "__t", iou.alias("__iou"))
    limits = F.array(*[F.struct(F.lit(i).alias("__k"), F.lit(float(x)).alias("__limit")) for i, x in enumerate(overlaps)])
    hits = owned.select(*by, "__t", "__iou", F.inline(limits))
    hit = F.col("__iou") > F.col("__limit")
    on_ignored = F.col("__t") == ignore
    points = hits.groupBy(*by, "__k").agg(
        F.count(F.lit(1)).alias("__n_p"),
        F.count_if(hit & ~on_ignored).alias("__tp"),
        F.count_if(hit & on_ignored).alias("__skipped"),
        F.count_distinct(F.when(hit & ~on_ignored, F.col("__t"))).alias("__found"),
    )
    true_ones = cells.where(F.col("__t") != ignore).groupBy(*by).agg(F.count_distinct("__t").alias("__n_t"))
    points = points.join(true_ones, by, "left") if by else points.crossJoin(true_ones)  # one row
    recall = F.coalesce(F.try_divide(F.col("__tp"), F.col("__tp") + F.coalesce("__n_t", F.lit(0)) - F.col("__found")), F.lit(0.0))
    precision = F.coalesce(F.try_divide(F.col("__tp"), F.col("__n_p") - F.col("__skipped")), F.lit(0.0))
    curve = points.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(recall.alias("r"), F.col("__k"), precision.alias("p")))).alias("__c"))  # a point a limit
    r = F.concat(F.array(F.lit(0.0)), F.transform("__c", lambda x: x["r"]), F.array(F.lit(1.0)))
    p = F.concat(F.transform("__c", lambda x: x["p"]), F.array(F.lit(0.0)))
    steps = F.transform(p, lambda x, i: (F.element_at(r, i + 2) - F.element_at(r, i + 1)) * F.array_max(F.slice(p, i + 1, F.size(p))))
    out = curve.select(*by, F.aggregate(steps, F.lit(0.0), lambda a, x: a + x).alias("average_precision"))
    return out if by else out.agg(F.coalesce(F.max("average_precision"), F.lit(0.0)).alias("average_precision"))


def psnr(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """10 log10(1 / mean squared error), the error being 0.01 at least."""
    mse = F.avg((F.col(truth) - F.col(predicted)) ** 2)
    return df.agg((10 * F.log10(1 / F.greatest(mse, F.lit(0.01)))).alias("psnr"))


def within_angle(df: DataFrame, truth: str, predicted: str, degrees: float) -> DataFrame:
    """Share of rows whose two unit vectors are less than an angle apart."""
    cosine = F.greatest(F.least(A.dot(F.col(truth), F.col(predicted)), F.lit(1.0)), F.lit(-1.0))
    return df.agg(F.avg((F.acos(cosine) < float(np.pi * degrees / 180)).cast("double")).alias("share"))


def inverse_angular_error(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """1 / sum of the angles (radians) between two directions of each row; both are scaled to just under a unit."""

    return df.agg(F.try_divide(F.lit(1.0), F.sum(A.angle(F.col(truth), F.col(predicted)))).alias("inverse_error"))


def label_file_faults(series: DataFrame, files: DataFrame, keys: list[str], name: str) -> DataFrame:
    """E2201: (code, keys, n_files) of series that haven't exactly one CSV of labels."""
    n = files.where(F.lower(F.col(name)).endswith(".csv")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = series.select(*keys).distinct().join(n, keys, "left").select(F.lit("E2201").alias("code"), *keys, F.coalesce("n", F.lit(0)).cast("long").alias("n_files"))
    return counted.where("n_files <> 1")


def label_table_faults(lines: DataFrame, keys: list[str], line: str = "line", place: str = "place") -> DataFrame:
    """E2202: (code, keys, n_columns) of label files that haven't two columns; an empty one has none.

    lines: the lines of each file with their place. The delimiter is the one of , ; tab |
    that splits the first line most often.
    """
    text = F.coalesce(F.col(line), F.lit(""))
    full = F.trim(text) != ""
    marks = [",", ";", "\t", "|"]

    def cells(t: Column) -> list[Column]:
        return [F.length(t) - F.length(F.replace(t, F.lit(m))) + 1 for m in marks]

    head = F.min_by(F.when(full, text), F.when(full, F.col(place)))
    n = lines.groupBy(*keys).agg(head.alias("head"), *[F.max(F.when(full, c)).alias(f"n{i}") for i, c in enumerate(cells(text))])
    own = F.transform(F.array(*cells(F.col("head"))), lambda x, i: F.struct(x.alias("n"), (-i).alias("i")))
    most = F.array_max(own)
    columns = F.when(F.col("head").isNull(), 0).otherwise(F.element_at(F.array(*[f"n{i}" for i in range(len(marks))]), 1 - most["i"]))
    return n.select(F.lit("E2202").alias("code"), *keys, columns.cast("long").alias("n_columns")).where("n_columns <> 2")


def file_count_faults(files: DataFrame, keys: list[str], name: str, extension: str, least: int, most: int | None = None) -> DataFrame:
    """E2101, E2102: keys with wrong extensions or a count of right ones out of bounds."""
    right = F.lower(F.col(name)).endswith(extension)
    n = files.groupBy(*keys).agg(F.count_if(right).alias("n_right"), F.count_if(~right).alias("n_wrong"))
    bad = (F.col("n_wrong") > 0) | (F.col("n_right") < least)
    return n.where(bad if most is None else bad | (F.col("n_right") > most))


def slice_label_faults(labels: DataFrame, slices: DataFrame, keys: list[str], name: str, label: str, allowed: list[str]) -> DataFrame:
    """(code, keys) of label tables that disagree: E2203 other number of rows, E2204 unknown slice, E2205 label not allowed."""
    a = labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_labels"), F.count_if(~F.col(label).isin(*allowed) | F.col(label).isNull()).alias("n_bad"))
    b = slices.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_slices"))
    unknown = labels.join(slices.select(*keys, name), [*keys, name], "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_unknown"))
    both = a.join(b, keys, "left").join(unknown, keys, "left")
    codes = F.array_compact(F.array(F.when(~F.col("n_labels").eqNullSafe(F.col("n_slices")), F.lit("E2203")), F.when(F.col("n_unknown") > 0, F.lit("E2204")), F.when(F.col("n_bad") > 0, F.lit("E2205"))))
    return both.select(F.explode(codes).alias("code"), *keys)


def patient_label_faults(labels: DataFrame, patients: DataFrame, key: str, label: str, allowed: list[str]) -> DataFrame:
    """(code, key): E2301 not exactly one label, E2302 a label that isn't allowed."""
    n = patients.select(key).distinct().join(labels, key, "left").groupBy(key).agg(F.count(label).alias("n"), F.count_if(~F.col(label).isin(*allowed)).alias("bad"))
    codes = F.array_compact(F.array(F.when(F.col("n") != 1, F.lit("E2301")), F.when(F.col("bad") > 0, F.lit("E2302"))))
    return n.select(F.explode(codes).alias("code"), key)


def position_faults(volumes: DataFrame, masks: DataFrame, keys: list[str], z: str, tolerance: float = 1e-4) -> DataFrame:
    """E4201: keys of which some slice, in the order of z, lies elsewhere in the mask than in the volume."""
    by = Window.partitionBy(*keys).orderBy(z)
    a, b = (d.select(*keys, F.round(z, 5).alias(n), F.row_number().over(by).alias("place")) for d, n in ((volumes, "za"), (masks, "zb")))
    return a.join(b, [*keys, "place"]).where(F.abs(F.col("za") - F.col("zb")) > tolerance).select(*keys).distinct()


def shape_faults(masks: DataFrame, keys: list[str]) -> DataFrame:
    """E4501: keys whose masks differ in shape."""
    return masks.groupBy(*keys).agg(F.count_distinct("h", "w").alias("n_shapes")).where("n_shapes > 1")


def mask_replicates(slices: DataFrame, keys: list[str], mask: str, order: str, pixels: str = "pixels", reach: int = 5) -> DataFrame:
    """E4701: (keys, fingerprint, n) of masks of a series that are equal around the middle of their slices that aren't black.

    Each slice is reduced to a hash first, so only hashes of a window of slices meet.
    """
    own = Window.partitionBy(*keys, mask)
    lit = slices.where(F.array_max(pixels) > 0).select(*keys, mask, F.xxhash64(pixels).alias("h"), (F.row_number().over(own.orderBy(order)) - 1).alias("i"), F.count(F.lit(1)).over(own).alias("m"))
    middle = lit.where(F.abs(F.col("i") - F.floor(F.col("m") / 2)) <= reach)
    printed = middle.groupBy(*keys, mask).agg(F.sort_array(F.collect_list(F.struct("i", "h"))).alias("w")).select(*keys, mask, F.xxhash64("w.h").alias("fingerprint"))
    return printed.groupBy(*keys, "fingerprint").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(mask)).alias("masks")).where("n > 1")


def unite_segments(voxels: DataFrame, keys: list[str], place: list[str], name: str, codes: dict[str, int]) -> DataFrame:
    """Segments of one name as one, with the protocol's code; segments without a code go."""
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return voxels.select(*keys, *place, F.try_element_at(table, F.col(name)).alias("label")).where("label is not null").distinct()


def drop_slices(masks: DataFrame, discarded: DataFrame, keys: list[str], index: str = "slice_idx") -> DataFrame:
    """Masks without the slices that a list, counting from 1, discards; `index` counts from 0."""
    gone = discarded.select(*keys, (F.col("discarded_slice") - 1).alias(index))
    return masks.join(gone, [*keys, index], "left_anti")


def follow_slices(labels: DataFrame, ordered: DataFrame, series: list[str]) -> DataFrame:
    """Labels by the slices' new places: ordered comes from order_slices, without the discarded ones."""
    return labels.join(ordered.select(*series, "slice_idx", "place"), [*series, "slice_idx"]).select(*series, "place", "label")


def masked(slices: DataFrame, image: str = "pixels", mask: str = "mask") -> DataFrame:
    """pixels times the mask; masks of 0 and 255 count as 0 and 1."""
    scale = F.when(F.array_max(mask) > 1, F.lit(255.0)).otherwise(F.lit(1.0))
    return slices.withColumn(image, A.let(scale, lambda s: F.zip_with(image, mask, lambda x, m: x * m / s)))


def first_series(slices: DataFrame, patient: str = "patient_id", series: str = "series_id") -> DataFrame:
    """The slices of each patient's first series by name."""
    first = slices.groupBy(patient).agg(F.min(series).alias(series))
    return slices.join(first, [patient, series], "left_semi")


def knee(values: list[float]) -> int:
    """Index of the knee of a rising curve: where it lies farthest under the line between its ends."""
    y = np.asarray(values, float)
    if len(y) < 3 or y[-1] == y[0]:
        return len(y) - 1
    x = np.linspace(0, 1, len(y))
    return int(np.argmax(x - (y - y[0]) / (y[-1] - y[0])))


def knee_clip(slices: DataFrame, series: list[str], pixels: str = "pixels") -> DataFrame:
    """pixels clipped above at the knee of their series' percentiles 95 to 99.99 (steps of 0.01).

    Percentiles are exact and come by ranks; a row a series is joined to its slices.
    """
    steps = [0.95 + i / 10_000 for i in range(500)]
    curves = exact_quantiles(slices.select(*series, F.explode(pixels).alias("v")), series, "v", steps)

    @F.pandas_udf("double")
    def top(curve):
        return curve.map(lambda c: float(c[knee(c)]))

    tops = curves.select(*series, top("quantiles").alias("top"))
    own = free_names(slices.columns, "top")[0]
    out = slices.join(tops.withColumnRenamed("top", own), series, "left")
    return out.withColumn(pixels, A.let(F.col(own), lambda t: F.transform(pixels, lambda v: F.least(v.cast("double"), t)))).drop(own)


def removal_union(*lists: DataFrame) -> DataFrame:
    """Every id that any of the lists removes, once; a list is one column of ids."""
    out = lists[0].toDF("id")
    for other in lists[1:]:
        out = out.unionByName(other.toDF("id"))
    return out.where("id is not null").distinct()


def lps_flips(cosines: Column) -> Column:
    """Which axes run against left, posterior and superior: r (columns), a (rows), i (slices), from row and column cosines of axial slices."""
    c = [F.element_at(cosines, i + 1) for i in range(6)]
    return F.concat(F.when(c[0] < 0, "r").otherwise(""), F.when(c[4] < 0, "a").otherwise(""), F.when(c[0] * c[4] - c[1] * c[3] < 0, "i").otherwise(""))


def to_lps(slices: DataFrame, flips: str = "flips", series: list[str] | None = None, index: str = "slice_idx") -> DataFrame:
    """pixels of slices whose axes run the other way, turned: flips holds r (columns), a (rows), i (slices) as needed.

    With `series`, slices of a series that runs downward are numbered from its other end.
    """
    if series:
        last = F.max(index).over(Window.partitionBy(*series))
        first = F.min(index).over(Window.partitionBy(*series))
        slices = slices.withColumn(index, F.when(F.col(flips).contains("i"), first + last - F.col(index)).otherwise(F.col(index)))
    x, h, w = F.col("pixels"), F.col("h"), F.col("w")
    place = F.sequence(F.lit(0), h * w - 1)

    def at(i):
        row, col = F.floor(i / w).cast("int"), i % w
        row = F.when(F.col(flips).contains("a"), h - 1 - row).otherwise(row)
        col = F.when(F.col(flips).contains("r"), w - 1 - col).otherwise(col)
        return F.element_at(x, (row * w + col + 1).cast("int"))

    return slices.withColumn("pixels", F.transform(place, at))
