"""Array and mask operators over the embeddings and measurements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from caresieve.functions import arrays as A
from caresieve.operators import images, losses, replicates
from caresieve.plans.register import registrar
from caresieve.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}
query = registrar(QUERIES, ORACLE)

_X = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"


def _rows(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", A.doubles(F.col("embedding")).alias("x"))


def _digest(c):
    """Sum, first and last value of an array, rounded."""
    return [F.round(A.total(c), 4).alias("total"), F.round(F.element_at(c, 1), 4).alias("first"), F.round(F.element_at(c, -1), 4).alias("last")]


_DIGEST = "round(list_sum(y), 4) AS total, round(y[1], 4) AS first, round(y[-1], 4) AS last"


@query(f"WITH s AS (SELECT vec_id, {_X} AS x FROM embeddings), b AS (SELECT vec_id, x, q[1] AS lo, q[2] AS hi FROM (SELECT vec_id, x, (SELECT quantile_cont(v, [0.01, 0.99]) FROM (SELECT unnest(x) AS v)) AS q FROM s)), c AS (SELECT vec_id, list_transform(x, lambda v: least(greatest(v, lo), hi)) AS y FROM b) SELECT vec_id, {_DIGEST} FROM c")
def tensor_clip_percentile(spark, sf):
    return _rows(spark, sf).select("vec_id", A.clip_percentiles(F.col("x"), 0.01, 0.99).alias("y")).select("vec_id", *_digest(F.col("y")))


@query(f"WITH s AS (SELECT vec_id, {_X} AS x FROM embeddings), c AS (SELECT vec_id, list_transform(x, lambda v: (v - list_min(x)) / (list_max(x) - list_min(x))) AS y FROM s) SELECT vec_id, {_DIGEST} FROM c")
def tensor_minmax_scale(spark, sf):
    return _rows(spark, sf).select("vec_id", A.min_max(F.col("x")).alias("y")).select("vec_id", *_digest(F.col("y")))


@query(f"WITH s AS (SELECT vec_id, {_X} AS x FROM embeddings), c AS (SELECT vec_id, list_transform(x, lambda v: (v - list_avg(x)) / list_stddev_pop(x)) AS y FROM s) SELECT vec_id, abs(round(list_sum(y), 4)) AS total, round(y[1], 4) AS first, round(y[-1], 4) AS last FROM c")
def tensor_znorm(spark, sf):
    out = _rows(spark, sf).select("vec_id", A.standardised(F.col("x")).alias("y")).select("vec_id", *_digest(F.col("y")))
    return out.withColumn("total", F.abs("total"))


@query(f"WITH s AS (SELECT vec_id, {_X} AS x FROM embeddings), c AS (SELECT vec_id, list_transform(x, lambda v: list_max(x) - v) AS y FROM s) SELECT vec_id, {_DIGEST} FROM c")
def tensor_monochrome(spark, sf):
    return _rows(spark, sf).select("vec_id", A.inverted(F.col("x")).alias("y")).select("vec_id", *_digest(F.col("y")))


@query(f"WITH s AS (SELECT vec_id, {_X} AS x FROM embeddings), c AS (SELECT vec_id, list_transform(x, lambda v: least(greatest(v * 500 + -100, -300.0), 300.0)) AS y FROM s) SELECT vec_id, {_DIGEST} FROM c")
def tensor_hounsfield(spark, sf):
    return _rows(spark, sf).select("vec_id", A.hounsfield(F.col("x"), F.lit(500.0), F.lit(-100.0), -300, 300).alias("y")).select("vec_id", *_digest(F.col("y")))


@query("SELECT vec_id FROM (SELECT vec_id, CASE WHEN vec_id % 40 = 0 THEN list_transform(embedding, lambda v: CAST(0 AS FLOAT)) ELSE embedding END AS e FROM embeddings) WHERE list_min(e) = list_max(e)")
def tensor_uniform_rows(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 40 == 0, F.transform("embedding", lambda v: F.lit(0.0).cast("float"))).otherwise(F.col("embedding")))
    slices = e.select(F.lit("p").alias("patient_id"), F.lit("s").alias("series_id"), F.col("vec_id").alias("slice_idx"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.col("embedding").alias("pixels"))
    return images.slice_checks(slices, 4, 4).where("code = 'E3401'").select(F.col("slice_idx").alias("vec_id"))


@query(f"WITH s AS (SELECT vec_id, label, {_X} AS x, lead({_X}) OVER (PARTITION BY label ORDER BY vec_id) AS y FROM embeddings), u AS (SELECT vec_id, unnest(x) AS a, unnest(y) AS b FROM s WHERE y IS NOT NULL) SELECT vec_id, round(corr(a, b), 6) AS ncc FROM u GROUP BY vec_id")
def tensor_ncc_adjacent(spark, sf):
    out = images.adjacent_correlation(_rows(spark, sf), ["label"], "vec_id", "x")
    return out.where("ncc is not null").select("vec_id", F.round("ncc", 6).alias("ncc"))


@query(
    f"""WITH s AS (SELECT label, {_X} AS x, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
u AS (SELECT label, generate_subscripts(x, 1) - 1 AS pixel, unnest(x) AS v FROM s WHERE abs(i - n // 2) <= 5) SELECT label, CAST(pixel AS INTEGER) AS pixel, max(v) AS value FROM u GROUP BY ALL"""
)
def tensor_mip(spark, sf):
    return images.projection(_rows(spark, sf), ["label"], "vec_id", "x").withColumn("pixel", F.col("pixel").cast("int"))


def _copied(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    near = F.transform("embedding", lambda v: v + F.lit(0.00001).cast("float"))
    return e.unionByName(e.where("vec_id % 50 = 0").select((F.col("vec_id") + 100_000).alias("vec_id"), near.alias("embedding")))


_COPIED = "SELECT vec_id, embedding FROM embeddings UNION ALL SELECT vec_id + 100000, list_transform(embedding, lambda v: v + CAST(0.00001 AS FLOAT)) FROM embeddings WHERE vec_id % 50 = 0"


@query(f"WITH c AS ({_COPIED}), d AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM c) SELECT a.vec_id AS a, b.vec_id AS b FROM d a JOIN d b ON a.vec_id < b.vec_id WHERE list_distance(a.x, b.x) < 0.001")
def tensor_replicate_pairs(spark, sf):
    return replicates.close_pairs(_copied(spark, sf), "vec_id", "embedding").select("a", "b")


@query(
    f"""WITH RECURSIVE c AS ({_COPIED}), d AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM c), l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM d a JOIN d b ON a.vec_id <> b.vec_id WHERE list_distance(a.x, b.x) < 0.001),
w AS (SELECT a AS k, a AS r FROM l UNION SELECT w.k, l.b FROM w JOIN l ON w.r = l.a) SELECT k AS vec_id, min(r) AS group_id, k = min(r) AS kept FROM w GROUP BY k"""
)
def tensor_replicate_groups(spark, sf):
    return replicates.replicate_groups(_copied(spark, sf), "vec_id", "embedding")


_PIXELS = "SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS v, label FROM embeddings"


def _labelled(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("i", "v"))
    truth = F.when(F.col("v") > 0.1, 1).when(F.col("v") < -0.1, 2).otherwise(0)
    return rows.select("vec_id", truth.alias("t"), F.when((F.col("i") + 1) % 7 == 0, 1).otherwise(truth).alias("p"))


_LABELLED = f"SELECT vec_id, t, CASE WHEN i % 7 = 0 THEN 1 ELSE t END AS p FROM (SELECT vec_id, i, CASE WHEN v > CAST(0.1 AS DOUBLE) THEN 1 WHEN v < CAST(-0.1 AS DOUBLE) THEN 2 ELSE 0 END AS t FROM ({_PIXELS}))"


@query(
    f"""WITH c AS ({_LABELLED}), l AS (SELECT DISTINCT t AS label FROM c) SELECT label, round(2 * count(*) FILTER (WHERE t = label AND p = label) / (count(*) FILTER (WHERE t = label) + count(*) FILTER (WHERE p = label)), 6) AS dice,
round(count(*) FILTER (WHERE t = label AND p = label) / count(*) FILTER (WHERE t = label OR p = label), 6) AS iou FROM c, l GROUP BY label"""
)
def mask_dice_iou(spark, sf):
    return images.mask_scores(_labelled(spark, sf), "t", "p").select("label", F.round("dice", 6).alias("dice"), F.round("iou", 6).alias("iou"))


@query(
    f"""WITH c AS (SELECT t, p, CAST(count(*) AS DOUBLE) AS n FROM ({_LABELLED}) GROUP BY t, p), a AS (SELECT sum(x * x) AS v FROM (SELECT sum(n) AS x FROM c WHERE t > 0 GROUP BY t)),
b AS (SELECT sum(x * x) AS v FROM (SELECT sum(n) AS x FROM c WHERE t > 0 AND p > 0 GROUP BY p)), d AS (SELECT sum(n * n) FILTER (WHERE p > 0) AS v, coalesce(sum(n) FILTER (WHERE p = 0), 0) AS o FROM c WHERE t > 0), z AS (SELECT sum(n) AS v FROM c),
r AS (SELECT (d.v + d.o / z.v) / (b.v + d.o / z.v) AS pr, (d.v + d.o / z.v) / a.v AS re FROM a, b, d, z) SELECT round(1 - 2 * pr * re / (pr + re), 6) AS error, round(pr, 6) AS "precision", round(re, 6) AS recall FROM r"""
)
def mask_adapted_rand(spark, sf):
    out = images.adapted_rand(_labelled(spark, sf), "t", "p")
    return out.select(*[F.round(c, 6).alias(c) for c in ("error", "precision", "recall")])


@query(f"WITH c AS ({_LABELLED}) SELECT round(10 * log10(1 / greatest(avg((t - p) * (t - p)), 0.01)), 6) AS psnr FROM c")
def mask_psnr(spark, sf):
    return images.psnr(_labelled(spark, sf), "t", "p").select(F.round("psnr", 6).alias("psnr"))


@query(
    f"""WITH c AS ({_LABELLED}), m AS (SELECT vec_id, list(DISTINCT t) AS l FROM c WHERE t <> 0 GROUP BY vec_id)
SELECT vec_id, array_to_string(list_filter([1, 3], lambda x: NOT list_contains(l, x)), ',') AS missing, array_to_string(list_sort(list_filter(l, lambda x: x NOT IN (1, 3))), ',') AS extra FROM m"""
)
def mask_label_faults(spark, sf):
    out = images.label_faults(_labelled(spark, sf), ["vec_id"], "t", [1, 3])
    return out.select("vec_id", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


@query(
    "WITH v AS (SELECT l_orderkey AS k, l_partkey % 50 AS place, l_linenumber AS segment FROM lineitem), o AS (SELECT k, place FROM v GROUP BY k, place HAVING count(DISTINCT segment) > 1) SELECT DISTINCT v.k, segment FROM v JOIN o ON v.k = o.k AND v.place = o.place"
)
def mask_voxel_overlap(spark, sf):
    v = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") % 50).alias("place"), F.col("l_linenumber").alias("segment"))
    return images.voxel_overlap(v, ["k"], "segment", ["place"])


@query("SELECT l_orderkey AS k, l_partkey % 50 AS place, max_by(l_linenumber, l_linenumber) AS label FROM lineitem GROUP BY ALL")
def mask_merge_labels(spark, sf):
    v = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") % 50).alias("place"), F.col("l_linenumber").alias("label"), F.col("l_linenumber").alias("o"))
    return images.merge_labels(v, ["k"], ["place"], "label", "o")


@query("SELECT vec_id, CASE WHEN abs(a) > abs(b) AND abs(a) > abs(c) THEN 'Axial' WHEN abs(b) > abs(c) AND abs(b) > abs(a) THEN 'Sagittal' WHEN abs(c) > abs(b) AND abs(c) > abs(a) THEN 'Coronal' ELSE 'Unknown' END AS plane FROM (SELECT vec_id, x[1] * x[5] - x[2] * x[4] AS a, x[2] * x[6] - x[3] * x[5] AS b, x[3] * x[4] - x[1] * x[6] AS c FROM (SELECT vec_id, " + _X + " AS x FROM embeddings))")
def tensor_orientation(spark, sf):
    return _rows(spark, sf).select("vec_id", images.orientation(F.slice("x", 1, 6)).alias("plane"))


@query("WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0) SELECT a.k, 'missing' AS problem FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT b.k, 'extra' FROM b WHERE k NOT IN (SELECT k FROM a)")
def structure_expected_files(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"))
    return images.expected_files(a, b, ["k"])


@query("WITH a AS (SELECT l_orderkey AS k, count(*) AS n_volume FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey AS k, count(*) AS n_mask FROM lineitem WHERE l_linenumber <= 4 GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, n_volume, n_mask FROM a FULL JOIN b ON a.k = b.k WHERE n_volume IS DISTINCT FROM n_mask")
def structure_slice_counts(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")
    return images.slice_count_faults(rows, rows.where("l_linenumber <= 4"), ["k"])


def _slices(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("label").alias("series"), F.col("vec_id").alias("slice_idx"), F.lit(8).alias("h"), F.lit(8).alias("w"), A.doubles(F.col("embedding")).alias("pixels"))


def _axis(m: int, n: int = 8) -> str:
    """SQL: (o, i, f): by how much pixel i of n counts in pixel o of m, smoothed where the axis shrinks, mirrored past its ends."""
    deviation = max(0.0, (n / m - 1) / 2)
    reach = int(4 * deviation + 0.5)
    mirror = lambda x: f"CASE WHEN {x} < 0 THEN -({x}) WHEN {x} > {n - 1} THEN {2 * (n - 1)} - ({x}) ELSE {x} END"
    weight = f"exp(-0.5 * (k / {deviation!r}) * (k / {deviation!r}))" if deviation else "1.0"
    return f"""(WITH b AS (SELECT j, {mirror('j + k')} AS i, {weight} AS g FROM (SELECT unnest(range({n})) AS j), (SELECT unnest(range({-reach}, {reach + 1})) AS k)),
b2 AS (SELECT j, i, g / sum(g) OVER (PARTITION BY j) AS g FROM b),
c AS (SELECT o, {mirror(f'((o + 0.5) * {n} / {m} - 0.5)')} AS c FROM (SELECT unnest(range({m})) AS o)),
l AS (SELECT o, CAST(floor(c) AS INTEGER) AS j, 1 - (c - floor(c)) AS t FROM c UNION ALL SELECT o, {mirror('CAST(floor(c) AS INTEGER) + 1')}, c - floor(c) FROM c)
SELECT o, i, sum(t * g) AS f FROM l JOIN b2 USING (j) GROUP BY o, i)"""


@query(
    f"""WITH y AS {_axis(4)}, z AS {_axis(6)},
p AS (SELECT vec_id, y.o AS i, z.o AS j, sum(e[y.i * 8 + z.i + 1] * y.f * z.f) AS v FROM (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings), y, z GROUP BY vec_id, y.o, z.o)
SELECT vec_id AS slice_idx, CAST(count(*) AS INTEGER) AS n, round(avg(v), 6) AS mean, round(max(v) FILTER (WHERE i = 3 AND j = 4), 6) AS late FROM p GROUP BY vec_id"""
)
def tensor_resize(spark, sf):
    out = images.resize(_slices(spark, sf), 4, 6)
    return out.select("slice_idx", F.size("pixels").alias("n"), F.round(A.mean(F.col("pixels")), 6).alias("mean"), F.round(F.element_at("pixels", 23), 6).alias("late"))


@query(
    f"""WITH s AS (SELECT label AS series, {_X} AS x, lead({_X}) OVER (PARTITION BY label ORDER BY vec_id) AS y, vec_id FROM embeddings), t AS (SELECT *, greatest(list_max(x) - list_min(x), list_max(y) - list_min(y)) AS span FROM s WHERE y IS NOT NULL),
o AS (SELECT a.i AS oy, b.i AS ox FROM (SELECT unnest(range(2)) AS i) a, (SELECT unnest(range(2)) AS i) b), d AS (SELECT a.i AS dy, b.i AS dx FROM (SELECT unnest(range(7)) AS i) a, (SELECT unnest(range(7)) AS i) b),
u AS (SELECT series, vec_id, span, oy, ox, x[(oy + dy) * 8 + ox + dx + 1] AS a, y[(oy + dy) * 8 + ox + dx + 1] AS b FROM t, o, d WHERE span > 0),
w AS (SELECT series, vec_id, span, avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS vab FROM u GROUP BY series, vec_id, span, oy, ox),
q AS (SELECT series, vec_id, avg((2 * ma * mb + pow(0.01 * span, 2)) * (2 * vab + pow(0.03 * span, 2)) / ((ma * ma + mb * mb + pow(0.01 * span, 2)) * (va + vb + pow(0.03 * span, 2)))) AS s FROM w GROUP BY series, vec_id)
SELECT series, round(stddev_pop(s), 6) AS sd_ssim, stddev_pop(s) < 0.005 AS flagged FROM q GROUP BY series HAVING count(*) >= 2"""
)
def tensor_series_similarity(spark, sf):
    return images.series_similarity(_slices(spark, sf), ["series"], "slice_idx").withColumn("sd_ssim", F.round("sd_ssim", 6))


@query("WITH c AS (SELECT CAST(toxic AS DOUBLE) AS y, 0.2 + 0.6 * quality AS p FROM labels) SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS bce, round(1 - 2 * sum(y * p) / sum(y * y + p * p), 6) AS dice, round(avg((y - p) * (y - p)), 6) AS mse FROM c")
def loss_values(spark, sf):
    rows = table(spark, sf, "labels").select(F.col("toxic").alias("y"), (0.2 + 0.6 * F.col("quality")).alias("p"))
    parts = [losses.binary_cross_entropy(rows, "y", "p"), losses.dice_loss(rows, "y", "p"), losses.squared_error(rows, "y", "p")]
    out = parts[0].select(F.round("loss", 6).alias("bce")).crossJoin(parts[1].select(F.round("loss", 6).alias("dice")))
    return out.crossJoin(parts[2].select(F.round("loss", 6).alias("mse")))  # single rows


@query(
    f"""WITH e AS (SELECT vec_id, label, {_X} AS x FROM embeddings), u AS (SELECT vec_id, label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM e), m AS (SELECT label, i, avg(v) AS m FROM u GROUP BY label, i),
d AS (SELECT vec_id, u.label, sqrt(sum((v - m) * (v - m))) AS d FROM u JOIN m ON u.label = m.label AND u.i = m.i GROUP BY vec_id, u.label), v AS (SELECT avg(x) AS variance FROM (SELECT avg(pow(greatest(d - 0.5, 0), 2)) AS x FROM d GROUP BY label)),
p AS (SELECT coalesce(avg(pow(greatest(3 - d, 0), 2)), 0) AS distance FROM (SELECT sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d FROM m a JOIN m b ON a.i = b.i AND a.label < b.label GROUP BY a.label, b.label)),
z AS (SELECT avg(x) AS size FROM (SELECT sqrt(sum(m * m)) AS x FROM m GROUP BY label)) SELECT round(variance, 6) AS variance, round(distance, 6) AS distance, round(size, 6) AS size, round(variance + distance + 0.001 * size, 6) AS loss FROM v, p, z"""
)
def loss_contrastive(spark, sf):
    return losses.contrastive(_rows(spark, sf), "label", "x").select(*[F.round(c, 6).alias(c) for c in ("variance", "distance", "size", "loss")])


@query(
    f"""WITH s AS (SELECT vec_id, label, {_X} AS x, lead({_X}) OVER (PARTITION BY label ORDER BY vec_id) AS y FROM embeddings), u AS (SELECT vec_id, label, unnest(x) AS a, unnest(y) AS b FROM s WHERE y IS NOT NULL),
c AS (SELECT label, vec_id, corr(a, b) AS ncc FROM u GROUP BY label, vec_id) SELECT label, count(*) FILTER (WHERE ncc < 0.8) AS n_unexpected, round(avg(ncc), 6) AS mean_ncc, round(median(ncc), 6) AS median_ncc, round(stddev_pop(ncc), 6) AS sd_ncc, count(*) FILTER (WHERE ncc < 0.8) > 0 AS flagged FROM c GROUP BY label"""
)
def tensor_series_alignment(spark, sf):
    out = images.alignment(_rows(spark, sf), ["label"], "vec_id", "MRI", "x")
    return out.select("label", "n_unexpected", *[F.round(c, 6).alias(c) for c in ("mean_ncc", "median_ncc", "sd_ncc")], "flagged")


@query("WITH c AS (SELECT vec_id, x[1] * x[5] - x[2] * x[4] AS a, x[2] * x[6] - x[3] * x[5] AS b, x[3] * x[4] - x[1] * x[6] AS c FROM (SELECT vec_id, " + _X + " AS x FROM embeddings)) SELECT 'E3301' AS code, vec_id, CASE WHEN vec_id % 10 = 0 THEN 'Unknown' WHEN abs(b) > abs(c) AND abs(b) > abs(a) THEN 'Sagittal' WHEN abs(c) > abs(b) AND abs(c) > abs(a) THEN 'Coronal' ELSE 'Unknown' END AS plane FROM c WHERE vec_id % 10 = 0 OR NOT (abs(a) > abs(b) AND abs(a) > abs(c))")
def tensor_plane_faults(spark, sf):
    rows = _rows(spark, sf).select("vec_id", F.when(F.col("vec_id") % 10 != 0, F.slice("x", 1, 6)).alias("cosines"))
    return images.plane_faults(rows, ["vec_id"])


@query(
    f"""WITH s AS (SELECT vec_id, {_X} AS x, lead({_X}) OVER (PARTITION BY label ORDER BY vec_id) AS y FROM embeddings), c AS (SELECT list_inner_product(x, y) / sqrt(list_inner_product(x, x) * list_inner_product(y, y)) * 0.999999 * 0.999999 AS c FROM s WHERE y IS NOT NULL) SELECT round(1 / sum(acos(c)), 9) AS inverse_error FROM c"""
)
def loss_inverse_angle(spark, sf):
    following = F.lead("x").over(Window.partitionBy("label").orderBy("vec_id"))
    pairs = _rows(spark, sf).withColumn("y", following).where("y is not null")
    return images.inverse_angular_error(pairs, "x", "y").select(F.round("inverse_error", 9).alias("inverse_error"))
