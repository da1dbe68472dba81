"""Volumes as ordered slices: stacking, shapes, flat images, and reorientation with axes exchanged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresieve.session import ship

#: Spacings of one volume that differ by more than this aren't even.
UNEVEN = 1e-3


def stack(slices: DataFrame, keys: list[str], z: str = "z", index: str = "slice_idx") -> DataFrame:
    """slices with place, from 0 by z; of equal z the one with the smaller index comes first, slices without z come last."""
    by = Window.partitionBy(*keys)
    return slices.withColumn("place", (F.row_number().over(by.orderBy(F.col(z).asc_nulls_last(), index)) - 1))


def volumes(stacked: DataFrame, keys: list[str], metadata: list[str], z: str = "z", index: str = "slice_idx") -> DataFrame:
    """A row per volume of `stack`: its shape, and what is known of each slice; pixels stay where they are.

    (keys, n_slices, shape array<int> of slices, rows, columns or null if slices differ,
    gap: the median distance of neighbours, even: whether all distances are alike,
    reordered: whether the slices' own order wasn't that of z, slices: array of
    struct<place, index, z, metadata...> by place).
    """
    about = F.struct("place", F.col(index).alias("slice_idx"), F.col(z).alias("z"), *metadata)
    held = stacked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_slices"), F.min("h").alias("h0"), F.max("h").alias("h1"), F.min("w").alias("w0"), F.max("w").alias("w1"), F.array_sort(F.collect_list(about)).alias("slices")
    )
    same = (F.col("h0") == F.col("h1")) & (F.col("w0") == F.col("w1"))
    gaps = F.filter(F.transform(F.slice("slices", 2, F.greatest(F.size("slices") - 1, F.lit(1))), lambda s, i: s["z"] - F.element_at("slices", i + 1)["z"]), lambda g: g.isNotNull())
    out = held.withColumn("gaps", F.when(F.size("slices") > 1, F.array_sort(gaps)).otherwise(F.array().cast("array<double>")))
    n = F.size("gaps")
    median = (F.try_element_at("gaps", F.floor((n + 1) / 2).cast("int")) + F.try_element_at("gaps", F.floor(n / 2).cast("int") + 1)) / 2
    order = F.transform("slices", lambda s: s["slice_idx"])
    return out.select(
        *keys,
        "n_slices",
        F.when(same, F.array(F.col("n_slices").cast("int"), F.col("h0"), F.col("w0"))).alias("shape"),
        F.when(n > 0, median).alias("gap"),
        F.when(n > 0, F.array_max("gaps") - F.array_min("gaps") <= UNEVEN).otherwise(F.lit(True)).alias("even"),
        (order != F.array_sort(order)).alias("reordered"),
        "slices",
    )


def shape_faults(images: DataFrame, masks: DataFrame, keys: list[str]) -> DataFrame:
    """E4801: (keys, problem, image_shape, mask_shape) of volumes whose mask is missing, has no volume, or has another shape.

    Both sides are slice rows with h and w. A shape is slices, rows, columns; slices
    that differ give a list of all sizes. Only counts a size are shuffled.
    """

    def shapes(df: DataFrame, name: str) -> DataFrame:
        sizes = df.groupBy(*keys, "h", "w").agg(F.count(F.lit(1)).alias("n"))
        one = F.concat_ws("x", F.col("n"), F.col("h"), F.col("w"))
        return sizes.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(one)), "+").alias(name))

    both = shapes(images, "image_shape").join(shapes(masks, "mask_shape"), keys, "full_outer")
    problem = F.when(F.col("image_shape").isNull(), "missing image").when(F.col("mask_shape").isNull(), "missing mask").when(F.col("image_shape") != F.col("mask_shape"), "shape")
    return both.select(F.lit("E4801").alias("code"), *keys, problem.alias("problem"), "image_shape", "mask_shape").where("problem is not null")


def flat_images(slices: DataFrame, keys: list[str]) -> DataFrame:
    """2-D extraction: files of one image as volumes of one slice, MONOCHROME1 turned to MONOCHROME2.

    A file of several slices isn't flat and gives none. (keys, slice_idx 0, h, w, photometric, pixels).
    """
    one = slices.where((F.col("n_slices") == 1) & F.col("pixels").isNotNull())
    top = F.array_max("pixels")
    turned = F.when(F.col("photometric") == "MONOCHROME1", F.transform("pixels", lambda p: top - p)).otherwise(F.col("pixels"))
    photometric = F.when(F.col("photometric") == "MONOCHROME1", "MONOCHROME2").otherwise(F.col("photometric"))
    return one.select(*keys, F.lit(0).alias("slice_idx"), "h", "w", photometric.alias("photometric"), turned.alias("pixels"))


def axis_codes(cosines: Column) -> Column:
    """Where columns, rows and slices run to, as in LPS: one of L R P A S I each, from row and column cosines.

    Each axis takes the patient direction nearest to it that the ones before left free; null without six cosines.
    """
    c = [F.get(cosines, i).cast("double") for i in range(6)]
    normal = [c[1] * c[5] - c[2] * c[4], c[2] * c[3] - c[0] * c[5], c[0] * c[4] - c[1] * c[3]]

    def nearest(v: list[Column], taken: list[Column]) -> Column:
        ranked = F.array(*[F.struct(F.when(F.array_contains(F.array(*taken), k) if taken else F.lit(False), -1.0).otherwise(F.abs(x)).alias("size"), F.lit(-k).alias("k"), (x < 0).alias("back")) for k, x in enumerate(v)])
        return F.array_max(ranked)

    first = nearest(c[:3], [])
    second = nearest(c[3:], [-first["k"]])
    third = nearest(normal, [-first["k"], -second["k"]])
    letter = lambda a: F.element_at(F.array(*[F.lit(x) for x in ("L", "R", "P", "A", "S", "I")]), (-a["k"] * 2 + a["back"].cast("int") + 1).cast("int"))
    return F.when(F.size(cosines) >= 6, F.concat(letter(first), letter(second), letter(third)))


def reorient(slices: DataFrame, keys: list[str], codes: str = "codes", to: str = "LPS") -> DataFrame:
    """(keys, slice_idx, h, w, pixels, codes) of volumes turned so that their axes run to `to`; any of the 48 orders of axes.

    slices: (keys, slice_idx from 0 without gaps, h, w, pixels); codes, the same on all
    slices of a volume, say where columns, rows and slices run. Each slice is cut into the strips
    of the new slices that it crosses; the strips of a new slice meet and are put side by
    side, so a task holds one slice at a time, whatever the volume's size. Volumes whose slices
    stay slices are turned one by one. Slices with codes that aren't three different axes are left out.
    """
    axis = {"L": 0, "R": 0, "P": 1, "A": 1, "S": 2, "I": 2}
    schema = slices.schema
    known = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in keys)
    n = F.max("slice_idx").over(Window.partitionBy(*keys)) + 1
    rows = slices.select(*keys, "slice_idx", "h", "w", F.transform("pixels", lambda p: p.cast("double")).alias("pixels"), F.col(codes).alias("codes"), n.cast("int").alias("n"))
    goal = [axis[c] for c in to]

    def plan(code: str) -> tuple[list[int], list[bool]] | None:
        """For columns, rows and slices of the result: the axis of the source, and whether it runs the other way."""
        if len(code or "") != 3 or any(c not in axis for c in code) or len({axis[c] for c in code}) != 3:
            return None
        own = [axis[c] for c in code]
        source = [own.index(g) for g in goal]
        return source, [code[s] != t for s, t in zip(source, to)]

    def cut(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("row", "place", "part", "h", "w", "strip")}
            for i, (z, h, w, pixels, code, depth) in enumerate(zip(*(batch.column(c) for c in ("slice_idx", "h", "w", "pixels", "codes", "n")))):
                found = plan(code.as_py())
                if found is None:
                    continue
                source, back = found
                z, h, w, depth = z.as_py(), h.as_py(), w.as_py(), depth.as_py()
                sizes = (w, h, depth)
                x = pixels.values.to_numpy(zero_copy_only=False).reshape(h, w)
                # of the two axes that lie in this slice, the one that becomes columns runs along the strips
                if source[2] == 2:
                    plane = x if source[0] == 0 else x.T
                    plane = plane[:: -1 if back[1] else 1, :: -1 if back[0] else 1]
                    strips = [(depth - 1 - z if back[2] else z, 0, plane)]
                else:
                    across = x.T if source[2] == 0 else x  # a line of it goes to each new slice
                    flat = source[0] != 2  # the line is a row of the new slice, else a column
                    turned = back[0] if flat else back[1]
                    at = depth - 1 - z if (back[1] if flat else back[0]) else z
                    strips = [(sizes[source[2]] - 1 - k if back[2] else k, at, line[:: -1 if turned else 1]) for k, line in enumerate(across)]
                for place, part, strip in strips:
                    for c, v in zip(out, (i, place, part, sizes[source[1]], sizes[source[0]], np.ascontiguousarray(strip).ravel())):
                        out[c].append(v)
            columns = [batch.column(k).take(pa.array(out["row"], pa.int32())) for k in keys]
            codes_of = batch.column("codes").take(pa.array(out["row"], pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns, codes_of, *(pa.array(out[c], pa.int32()) for c in ("place", "part", "h", "w")), pa.array(out["strip"], pa.list_(pa.float64()))], [*keys, "codes", "place", "part", "h", "w", "strip"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        h, w, code = (table.column(c)[0].as_py() for c in ("h", "w", "codes"))
        x = table.column("strip").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        columns = plan(code)[0][0] == 2  # the strips are columns
        x = x.reshape(w, h).T if columns else x.reshape(h, w)
        one = table.slice(0, 1)
        return pa.table({**{k: one.column(k) for k in keys}, "slice_idx": one.column("place"), "h": one.column("h"), "w": one.column("w"), "pixels": pa.array([np.ascontiguousarray(x).ravel()], pa.list_(pa.float64())), "codes": pa.array([to])})

    ship(slices.sparkSession)
    strips = rows.mapInArrow(cut, f"{known}, codes string, place int, part int, h int, w int, strip array<double>")
    return strips.groupBy(*keys, "place").applyInArrow(join, f"{known}, slice_idx int, h int, w int, pixels array<double>, codes string")
