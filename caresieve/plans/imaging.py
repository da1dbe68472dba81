"""Volumes, rasters and nested tags: files written from the vectors, components, patches, orientation, contrast."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from caresieve.functions import arrays as A
from caresieve.functions.text import base_name
from caresieve.operators import clusters, images, raster, stacks, tags
from caresieve.operators.skew import shared_folder
from caresieve.plans.register import registrar
from caresieve.sources import volumes
from caresieve.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}
query = registrar(QUERIES, ORACLE)

#: A volume is 16 vectors, each a slice of 8 x 8.
_X = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"
_E = f"SELECT vec_id // 16 AS volume, CAST(vec_id % 16 AS INTEGER) AS slice_idx, label, {_X} AS x FROM embeddings"


def _slices(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 16).alias("volume"), (F.col("vec_id") % 16).cast("int").alias("slice_idx"), "label", A.doubles(F.col("embedding")).alias("pixels"))
    return rows.withColumns({"h": F.lit(8), "w": F.lit(8)})


#: Formats that hold places, by volume.
_FORMS = ("nrrd", "nrrd.gz", "nifti", "nifti.gz")


def _written(spark, slices, dtype="f4"):
    """The slices as files of several formats, by volume, and read again: rows as they come from files."""
    form = F.element_at(F.array(*[F.lit(x) for x in _FORMS]), (F.pmod("volume", F.lit(len(_FORMS))) + 1).cast("int"))
    folder = f"{shared_folder(spark)}/volumes-{uuid.uuid4().hex}"
    volumes.write_files(volumes.volume_files(slices.withColumn("form", form), "volume", dtype), folder).count()
    read = volumes.read_volumes(spark, folder)
    return read.withColumn("volume", F.regexp_extract(base_name(F.col("path")), r"^(-?\d+)\.", 1).cast("bigint"))


@query(
    f"""WITH s AS ({_E}), n AS (SELECT volume, CAST(count(*) AS INTEGER) AS n_slices FROM s GROUP BY volume)
SELECT s.volume, s.slice_idx, CASE WHEN s.volume % 4 < 2 THEN 'nrrd' ELSE 'nifti' END AS format, n_slices, 8 AS h, 8 AS w, CAST(2.5 * slice_idx - 7 AS DOUBLE) AS z, 32 AS bits, round(list_sum(x), 4) AS total, round(x[1], 4) AS first, round(x[-1], 4) AS last FROM s JOIN n USING (volume)"""
)
def source_volumes(spark, sf):
    """Volumes written as NRRD and NIfTI files, plain and packed, and read by the data source."""
    rows = _slices(spark, sf).withColumns({"spacing": F.array(F.lit(0.5), F.lit(0.75), F.lit(2.5)), "position": F.array(F.lit(1.0), F.lit(2.0), F.lit(-7.0)), "cosines": F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 1, 0)])})
    return _written(spark, rows).select("volume", "slice_idx", "format", "n_slices", "h", "w", F.round("z", 6).alias("z"), "bits", F.round(A.total(F.col("pixels")), 4).alias("total"), F.round(F.element_at("pixels", 1), 4).alias("first"), F.round(F.element_at("pixels", -1), 4).alias("last"))


@query(
    """WITH v AS (SELECT vec_id // 16 AS volume, count(*) AS n FROM embeddings GROUP BY 1),
s AS (SELECT volume, n || 'x8x8' AS image_shape, CASE WHEN volume % 5 = 1 THEN n - 1 ELSE n END AS m, CASE WHEN volume % 7 = 2 THEN '4x16' ELSE '8x8' END AS size FROM v),
f AS (SELECT volume, CASE WHEN volume % 11 <> 4 THEN image_shape END AS image_shape, CASE WHEN volume % 3 <> 2 AND m > 0 THEN m || 'x' || size END AS mask_shape FROM s)
SELECT 'E4801' AS code, volume, CASE WHEN image_shape IS NULL THEN 'missing image' WHEN mask_shape IS NULL THEN 'missing mask' ELSE 'shape' END AS problem, image_shape, mask_shape FROM f
WHERE (image_shape IS NOT NULL OR mask_shape IS NOT NULL) AND image_shape IS DISTINCT FROM mask_shape"""
)
def structure_volume_shapes(spark, sf):
    """E4801: masks read from files that lack a slice, have other sides, or whose volume or mask isn't there."""
    rows = _slices(spark, sf)
    wide = F.col("volume") % 7 == 2
    masks = rows.where((F.col("volume") % 3 != 2) & ~((F.col("volume") % 5 == 1) & (F.col("slice_idx") == 0)))
    masks = masks.withColumns({"pixels": F.transform("pixels", lambda v: (v > 0).cast("double")), "h": F.when(wide, 4).otherwise(8), "w": F.when(wide, 16).otherwise(8)})
    return stacks.shape_faults(_written(spark, rows.where("volume % 11 <> 4")), _written(spark, masks, "u1"), ["volume"])


@query(
    f"""WITH s AS (SELECT volume, slice_idx, x, CAST((slice_idx * 5 + volume) % 16 AS DOUBLE) * 1.5 AS z FROM ({_E})),
p AS (SELECT *, row_number() OVER (PARTITION BY volume ORDER BY z, slice_idx) - 1 AS place FROM s),
g AS (SELECT volume, z - lag(z) OVER w AS gap, slice_idx < lag(slice_idx) OVER w AS back FROM p WINDOW w AS (PARTITION BY volume ORDER BY place)),
v AS (SELECT volume, median(gap) AS gap, coalesce(max(gap) - min(gap) <= 0.001, true) AS even, coalesce(bool_or(back), false) AS reordered FROM g GROUP BY volume)
SELECT volume, count(*) AS n_slices, count(*) || 'x8x8' AS shape, round(gap, 6) AS gap, even, reordered, string_agg(slice_idx, ',' ORDER BY place) AS places FROM p JOIN v USING (volume) GROUP BY ALL"""
)
def structure_volume_stack(spark, sf):
    """Slices that come out of order, stacked by z, with what each volume says of its slices."""
    rows = _slices(spark, sf).withColumn("z", F.pmod(F.col("slice_idx") * 5 + F.col("volume"), F.lit(16)).cast("double") * 1.5)
    out = stacks.volumes(stacks.stack(rows, ["volume"]), ["volume"], ["label"])
    return out.select("volume", "n_slices", F.array_join("shape", "x").alias("shape"), F.round("gap", 6).alias("gap"), "even", "reordered", F.array_join(F.transform("slices", lambda s: s["slice_idx"].cast("string")), ",").alias("places"))


@query(f"SELECT vec_id AS image, CASE WHEN vec_id % 3 = 0 THEN 'MONOCHROME2' ELSE 'other' END AS photometric, round(list_sum(CASE WHEN vec_id % 3 = 0 THEN list_transform(x, lambda v: list_max(x) - v) ELSE x END), 4) AS total, round(CASE WHEN vec_id % 3 = 0 THEN list_max(x) - x[1] ELSE x[1] END, 4) AS first FROM (SELECT vec_id, {_X} AS x FROM embeddings WHERE vec_id % 4 <> 3)")
def tensor_flat_images(spark, sf):
    """2-D extraction: images of one slice; every fourth file holds several and isn't flat."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("image"), F.when(F.col("vec_id") % 4 == 3, 2).otherwise(1).alias("n_slices"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.when(F.col("vec_id") % 3 == 0, "MONOCHROME1").otherwise("other").alias("photometric"), A.doubles(F.col("embedding")).alias("pixels"))
    return stacks.flat_images(rows, ["image"]).select("image", "photometric", F.round(A.total(F.col("pixels")), 4).alias("total"), F.round(F.element_at("pixels", 1), 4).alias("first"))


@query(
    f"""WITH s AS ({_E}), n AS (SELECT volume, count(*) AS n FROM s GROUP BY volume),
v AS (SELECT s.volume, slice_idx AS z, i // 8 AS y, i % 8 AS c, x[i + 1] AS value, n FROM s JOIN n USING (volume), (SELECT unnest(range(64)) AS i)),
r AS (SELECT volume, value, CASE volume % 3 WHEN 0 THEN y WHEN 1 THEN 7 - y ELSE z END AS slice_idx, CASE volume % 3 WHEN 0 THEN n - 1 - z WHEN 1 THEN c ELSE y END AS b, CASE volume % 3 WHEN 0 THEN c WHEN 1 THEN n - 1 - z ELSE c END AS a,
  CASE volume % 3 WHEN 0 THEN 8 WHEN 1 THEN n ELSE 8 END AS w, CASE volume % 3 WHEN 0 THEN n ELSE 8 END AS h FROM v)
SELECT volume, CAST(slice_idx AS INTEGER) AS slice_idx, CAST(h AS INTEGER) AS h, CAST(w AS INTEGER) AS w, round(sum(value * (1 + b * w + a)), 4) AS weighted FROM r GROUP BY volume, slice_idx, h, w"""
)
def tensor_reorient_axes(spark, sf):
    """Volumes that were taken in other planes, turned to left, posterior, superior: coronal, sagittal and axial ones."""
    turn = F.when(F.col("volume") % 3 == 0, F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 0, 1)])).when(F.col("volume") % 3 == 1, F.array(*[F.lit(float(x)) for x in (0, 1, 0, 0, 0, -1)])).otherwise(F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 1, 0)]))
    out = stacks.reorient(_slices(spark, sf).withColumn("codes", stacks.axis_codes(turn)), ["volume"])
    weighted = F.aggregate(F.transform("pixels", lambda p, i: p * (i + 1)), F.lit(0.0), lambda a, p: a + p)
    return out.select("volume", "slice_idx", "h", "w", F.round(weighted, 4).alias("weighted"))


#: Every sixth voxel or so is inside, far from where components would fill a volume.
_MASK = 0.1
_VOXELS = f"v AS (SELECT volume, slice_idx AS z, i // 8 AS y, i % 8 AS c, x[i + 1] AS value, label FROM ({_E}), (SELECT unnest(range(64)) AS i))"


def _labels(source: str) -> str:
    """SQL: l (volume, z, y, c, label) of the components of m (volume, p), p the place of a voxel, by walking from each voxel to its neighbours."""
    return f"""m AS ({source}),
w AS (SELECT volume, p, p AS root FROM m UNION
  SELECT w.volume, m.p, w.root FROM w JOIN m ON w.volume = m.volume AND (abs(m.p - w.p) = 64 OR (abs(m.p - w.p) = 8 AND m.p // 64 = w.p // 64) OR (abs(m.p - w.p) = 1 AND m.p // 8 = w.p // 8))),
l AS (SELECT volume, p, min(root) + 1 AS label FROM w GROUP BY volume, p)"""


@query(f"WITH RECURSIVE {_VOXELS}, {_labels(f'SELECT volume, z * 64 + y * 8 + c AS p FROM v WHERE value > {_MASK}')} SELECT volume, label, count(*) AS n_voxels, count(DISTINCT p // 64) AS n_slices, CAST(max(p // 64) AS INTEGER) AS last_slice FROM l GROUP BY volume, label")
def mask_components(spark, sf):
    """Connected components of masks over whole volumes, labelled in blocks of 4 slices and 3 rows."""
    rows = _slices(spark, sf).withColumn("mask", raster.above("pixels", _MASK))
    runs = raster.connected_components(rows, ["volume"], "mask", block=(4, 3))
    return runs.groupBy("volume", "label").agg(F.sum("length").alias("n_voxels"), F.count_distinct("slice_idx").alias("n_slices"), F.max("slice_idx").alias("last_slice"))


@query(
    f"""WITH RECURSIVE {_VOXELS}, {_labels(f'SELECT volume, z * 64 + y * 8 + c AS p FROM v WHERE NOT value > -{_MASK / 4}')},
t AS (SELECT v.volume, z * 64 + y * 8 + c AS p, CASE WHEN value < 0 THEN 1 + z // 4 ELSE 0 END AS t FROM v),
c AS (SELECT t, coalesce(l.label, 0) AS p, count(*) AS n FROM t LEFT JOIN l ON t.volume = l.volume AND t.p = l.p GROUP BY 1, 2),
i AS (SELECT * FROM c WHERE t > 0),
a AS (SELECT sum(x * x) AS a FROM (SELECT CAST(sum(n) AS DOUBLE) AS x FROM i GROUP BY t)), b AS (SELECT sum(x * x) AS b FROM (SELECT CAST(sum(n) AS DOUBLE) AS x FROM i WHERE p > 0 GROUP BY p)),
s AS (SELECT coalesce(sum(CAST(n AS DOUBLE) * n) FILTER (WHERE p > 0), 0) + coalesce(sum(n) FILTER (WHERE p = 0), 0) / (SELECT sum(n) FROM c) AS ab, coalesce(sum(n) FILTER (WHERE p = 0), 0) / (SELECT sum(n) FROM c) AS o FROM i),
q AS (SELECT ab / greatest(b + o, 1e-6) AS precision, ab / greatest(a, 1e-6) AS recall FROM s, a, b)
SELECT round(1 - 2 * precision * recall / greatest(precision + recall, 1e-6), 9) AS error, round(precision, 9) AS precision, round(recall, 9) AS recall FROM q"""
)
def mask_boundary_rand(spark, sf):
    """The adapted Rand error of what a boundary prediction encloses, against slabs of four slices."""
    rows = _slices(spark, sf).withColumn("truth", F.transform("pixels", lambda v: F.when(v < 0, 1 + F.floor(F.col("slice_idx") / 4)).otherwise(0)))
    return raster.boundary_rand_error(rows, ["volume"], "truth", "pixels", -_MASK / 4).select(F.round("error", 9).alias("error"), F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query(
    f"""WITH {_VOXELS}, n AS (SELECT volume, max(z) + 1 AS n FROM v GROUP BY volume),
s AS (SELECT volume, n, z0 FROM n, (SELECT unnest(range(16)) AS z0) WHERE (z0 % 3 = 0 AND z0 <= greatest(n - 5, 0)) OR z0 = greatest(n - 5, 0)),
t AS (SELECT s.volume, z0, y0, c0, z, y, c, value, n FROM s JOIN v ON v.volume = s.volume AND v.z >= z0 AND v.z < z0 + 5, (SELECT unnest([0, 3]) AS y0), (SELECT unnest([0, 2]) AS c0) WHERE y >= y0 AND y < y0 + 5 AND c >= c0 AND c < c0 + 6),
d AS (SELECT *, value - avg(value) OVER (PARTITION BY volume, z0, y0, c0) AS x FROM t)
SELECT volume, CAST(z AS INTEGER) AS slice_idx, count(*) AS n, round(sum(m), 6) AS total, round(sum(m * (y * 8 + c)), 6) AS weighted FROM (SELECT volume, z, y, c, avg(x) AS m FROM d GROUP BY volume, z, y, c) GROUP BY volume, z"""
)
def tensor_patches(spark, sf):
    """Overlapping patches, each freed of its mean, stitched to volumes again."""
    tiles = raster.split(_slices(spark, sf), ["volume"], (5, 5, 6), (3, 3, 2))
    out = raster.stitch(raster.each_patch(tiles, ["volume"], lambda x: x - x.mean()), ["volume"])
    weighted = F.aggregate(F.transform("pixels", lambda p, i: p * i), F.lit(0.0), lambda a, p: a + p)
    return out.select("volume", "slice_idx", F.size("pixels").cast("long").alias("n"), F.round(A.total(F.col("pixels")), 6).alias("total"), F.round(weighted, 6).alias("weighted"))


@query(
    """WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '{"Study":[{"Series":[{"Item":[' || props || ']}]}],"note":null}' WHEN 2 THEN '{"Other":{"a":[1,[2,' || props || ']]},"k":" "}' ELSE '{"Listed":[{"x":' || event_id || ',"y":{"z":"' || event_type || '"}}],"PatientIdentityRemoved":"no"}' END AS tags FROM events),
l AS (SELECT event_id, regexp_replace(substr(t.fullkey, 3), '"', '', 'g') AS path, t.key AS tag, t.atom AS value, t.type AS type FROM e, json_tree(e.tags) t WHERE t.type NOT IN ('OBJECT', 'ARRAY'))
SELECT 'E3001' AS code, event_id, path, tag FROM (SELECT event_id, CASE WHEN path LIKE '%[%' THEN list_aggregate(list_transform(regexp_extract_all(path, '[^\\[\\]]+|\\[[0-9]+\\]'), lambda x: CASE WHEN x LIKE '[%' THEN '[' || (CAST(x[2:-2] AS INTEGER) + 1) || ']' ELSE x END), 'string_agg', '') ELSE path END AS path,
  tag, value FROM l WHERE (tag = 'k' OR path LIKE 'Listed%') AND coalesce(trim(value, ' "'), '') NOT IN ('', 'null') OR tag = 'PatientIdentityRemoved' AND upper(trim(value, '"')) <> 'YES')"""
)
def structure_nested_tags(spark, sf):
    """E3001: listed tags, and what listed sequences hold, at any depth of nested texts."""
    e, p = table(spark, sf, "events"), F.col("props")
    wrap = lambda *parts: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])
    kinds = [p, wrap('{"Study":[{"Series":[{"Item":[', p, ']}]}],"note":null}'), wrap('{"Other":{"a":[1,[2,', p, ']]},"k":" "}'), wrap('{"Listed":[{"x":', F.col("event_id"), ',"y":{"z":"', F.col("event_type"), '"}}],"PatientIdentityRemoved":"no"}')]
    text = F.element_at(F.array(*kinds), (F.col("event_id") % 4 + 1).cast("int"))
    return tags.anonymisation_faults(e.select("event_id", text.alias("tags")), ["event_id"], "tags", ["k", "Listed"])


@query(
    f"""WITH s AS (SELECT vec_id, {_X} AS x FROM embeddings),
u AS (SELECT vec_id, list_transform(x, lambda v: CAST(trunc((v - list_min(x)) / (list_max(x) - list_min(x)) * 255) AS INTEGER)) AS q FROM s),
p AS (SELECT vec_id, i, (SELECT sum(CASE WHEN q[i + 1] >= q[greatest(least(i // 8 + dy, 7), 0) * 8 + greatest(least(i % 8 + dx, 7), 0) + 1] THEN 255 ELSE 0 END) FROM (SELECT unnest([-1, 0]) AS dy), (SELECT unnest([-1, 0]) AS dx)) / 4 AS v FROM u, (SELECT unnest(range(64)) AS i)),
r AS (SELECT vec_id, i, CASE WHEN v = 127.5 THEN 128 ELSE round(v) END AS v FROM p)
SELECT vec_id AS slice_idx, CAST(sum(v) AS DOUBLE) AS total, CAST(sum(v * i) AS DOUBLE) AS weighted FROM r GROUP BY vec_id"""
)
def tensor_clahe(spark, sf):
    """Contrast equalised by tiles: of one pixel each, as slices are 8 x 8."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("slice_idx"), F.lit(8).alias("h"), F.lit(8).alias("w"), A.doubles(F.col("embedding")).alias("pixels"))
    out = images.clahe(rows)
    return out.select("slice_idx", A.total(F.col("pixels")).alias("total"), F.aggregate(F.transform("pixels", lambda p, i: p * i), F.lit(0.0), lambda a, p: a + p).alias("weighted"))


def _points(spark, sf):
    return table(spark, sf, "embeddings").select((F.col("label") % 2).alias("half"), "vec_id", F.slice(A.doubles(F.col("embedding")), 1, 4).alias("x"))


@query()
def tensor_density_clusters(spark, sf):
    """Density clusters of the first four values of the vectors, in two groups; brute force is in the tests."""
    return clusters.density_clusters(_points(spark, sf), ["half"], "vec_id", "x", 8, 4)


@query()
def tensor_mean_shift(spark, sf):
    """Modes of the first four values of the vectors, in two groups; brute force is in the tests."""
    return clusters.mean_shift(_points(spark, sf), ["half"], "vec_id", "x", 0.25)
