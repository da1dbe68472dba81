"""Multi-site statistics: only one row per site (or site pair) leaves the site stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresieve.functions.arrays import doubles
from caresieve.operators import covariance as cov
from caresieve.operators import learning, similarity, wide
from caresieve.operators.moments import local_moments, pooled_moments
from caresieve.operators.skew import cut
from caresieve.plans.register import registrar
from caresieve.sources.tables import measurements_by_site, table
from caresieve.streaming import gather

VARS = ["l_quantity", "l_extendedprice", "l_discount"]
QUERIES: dict = {}
ORACLE: dict = {}

SITE_SQL = """SELECT l.*, r_name AS site FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


query = registrar(QUERIES, ORACLE)


@query(
    f"SELECT site, count(*) AS n, {', '.join(f'round(avg({c}), 5) AS mean_{c}, round(stddev_pop({c}), 5) AS sd_{c}' for c in VARS)} FROM ({SITE_SQL}) GROUP BY site",
)
def fed_local_moments(spark, sf):
    m = local_moments(measurements_by_site(spark, sf), "site", VARS)
    return m.select("site", "n", *[F.round(f"{k}_{c}", 5).alias(f"{k}_{c}") for c in VARS for k in ("mean", "sd")])


@query(
    f"SELECT count(*) AS n_total, {', '.join(f'round(avg({c}), 5) AS mean_{c}, round(stddev_pop({c}), 5) AS sd_{c}' for c in VARS)} FROM ({SITE_SQL})",
)
def fed_pooled_moments(spark, sf):
    m = pooled_moments(local_moments(measurements_by_site(spark, sf), "site", VARS), VARS)
    return m.select(F.col("n_total").cast("long").alias("n_total"), *[F.round(f"{k}_{c}", 5).alias(f"{k}_{c}") for c in VARS for k in ("mean", "sd")])


def _long_matrix(spark, m, name):
    rows = [(VARS[i], VARS[j], round(float(m[i, j]), 4)) for i in range(len(VARS)) for j in range(len(VARS))]
    return spark.createDataFrame(rows, f"a string, b string, {name} double")


def _matrix_sql(f: str) -> str:
    cells = [f"SELECT '{a}' AS a, '{b}' AS b, round({f}({a}, {b}), 4) AS {{name}} FROM s" for a in VARS for b in VARS]
    return f"WITH s AS ({SITE_SQL}) " + " UNION ALL ".join(cells)


@query(_matrix_sql("covar_samp").replace("{name}", "covariance"))
def fed_scatter_covariance(spark, sf):
    stats = cov.pooled(cov.local_scatter(measurements_by_site(spark, sf), "site", VARS))
    return _long_matrix(spark, stats.covariance, "covariance")


@query(_matrix_sql("corr").replace("{name}", "correlation"))
def fed_correlation(spark, sf):
    stats = cov.pooled(cov.local_scatter(measurements_by_site(spark, sf), "site", VARS))
    return _long_matrix(spark, stats.correlation, "correlation")


#: Eigenvalues of the 3 x 3 correlation matrix in closed form, largest first.
_EIGEN = f"""s AS ({SITE_SQL}), r AS (SELECT corr({VARS[0]}, {VARS[1]}) AS a, corr({VARS[0]}, {VARS[2]}) AS b, corr({VARS[1]}, {VARS[2]}) AS c FROM s),
p AS (SELECT a, b, c, sqrt((a * a + b * b + c * c) / 3) AS p FROM r), f AS (SELECT a, b, c, p, acos(least(1, greatest(-1, a * b * c / (p * p * p)))) / 3 AS f FROM p),
l AS (SELECT a, b, c, i + 1 AS component, 1 + 2 * p * cos(f + (CASE i WHEN 0 THEN 0 WHEN 1 THEN 4 ELSE 2 END) * pi() / 3) AS l FROM f, (SELECT unnest(range(3)) AS i)),
e AS (SELECT *, l / 3 AS explained, coalesce(sum(l / 3) OVER (ORDER BY component ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.7 - 1e-12 AS kept FROM l)"""


@query(f"WITH {_EIGEN} SELECT CAST(component AS INTEGER) AS component, round(explained, 6) AS explained, kept FROM e")
def fed_pca_explained(spark, sf):
    stats = cov.pooled(cov.local_scatter(measurements_by_site(spark, sf), "site", VARS))
    found = cov.principal_components(stats.correlation)
    return spark.createDataFrame([(i + 1, round(float(x), 6), i < found.kept) for i, x in enumerate(found.explained)], "component int, explained double, kept boolean")


@query(
    f"""WITH s AS ({SITE_SQL}), m AS (SELECT site, avg(l_quantity) AS q, var_samp(l_quantity) AS vq, avg(l_discount) AS d, var_samp(l_discount) AS vd FROM s GROUP BY site)
SELECT s.site, count(*) AS n, count(*) FILTER (WHERE (l_quantity - q) ** 2 / vq + (l_discount - d) ** 2 / vd > 4) AS n_far,
round(max((l_quantity - q) ** 2 / vq + (l_discount - d) ** 2 / vd), 6) AS max_t2 FROM s JOIN m ON s.site = m.site GROUP BY s.site"""
)
def fed_t2_distances(spark, sf):
    rows = cov.t2_outliers(measurements_by_site(spark, sf), "site", ["l_quantity", "l_discount"])
    return rows.groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("t2") > 4).alias("n_far"), F.round(F.max("t2"), 6).alias("max_t2"))


_Z = [f"({c} - (SELECT avg({c}) FROM s)) / (SELECT stddev_samp({c}) FROM s)" for c in VARS]


#: The F quantile at 0.95 for k and n - k degrees: its density over u = sqrt(x) is summed by Simpson's rule in 4,000 cells up to u = 2.
_F_DENSITY = "2 * {u} * exp(lgamma(n / 2) - lgamma(k / 2) - lgamma((n - k) / 2) + k / 2 * ln(k / (n - k)) + (k - 2) * ln({u}) - n / 2 * ln(1 + k * {u} * {u} / (n - k)))"
_F_CELLS = ", ".join(_F_DENSITY.format(u=f"greatest((i + {x}) * 0.0005, 1e-9)") + f" AS f{j}" for j, x in enumerate((0, 0.5, 1)))


@query(
    f"""WITH {_EIGEN}, v AS (SELECT component, a * c - b * (1 - l) AS x, a * b - (1 - l) * c AS y, (1 - l) * (1 - l) - a * a AS z FROM e WHERE kept),
d AS (SELECT row_number() OVER () AS rid, site, l_orderkey, l_linenumber, {', '.join(f'{z} AS z{i}' for i, z in enumerate(_Z))} FROM s), q AS (SELECT rid, site, l_orderkey, l_linenumber, component, x * z0 + y * z1 + z * z2 AS q FROM d, v),
m AS (SELECT site, component, avg(q) AS m, var_samp(q) AS w, count(*) AS n FROM q GROUP BY site, component), k AS (SELECT site, CAST(any_value(n) AS DOUBLE) AS n, CAST(count(*) AS DOUBLE) AS k FROM m GROUP BY site),
g AS (SELECT site, n, k, i, {_F_CELLS} FROM k, (SELECT unnest(range(4000)) AS i)), c AS (SELECT site, n, k, i, sum((f0 + 4 * f1 + f2) * 0.0005 / 6) OVER (PARTITION BY site ORDER BY i) AS p, (f0 + 4 * f1 + f2) * 0.0005 / 6 AS own FROM g),
h AS (SELECT site, k * (n - 1) / (n - k) * pow(0.0005 * (i + (0.95 - p + own) / own), 2) AS top FROM c WHERE p >= 0.95 AND p - own < 0.95),
t AS (SELECT rid, q.site, l_orderkey, l_linenumber, sum((q - m) * (q - m) / w) AS t2 FROM q JOIN m ON q.site = m.site AND q.component = m.component GROUP BY ALL)
SELECT t.site, l_orderkey, l_linenumber, round(t2, 6) AS t2 FROM t JOIN h ON t.site = h.site WHERE t2 > top"""
)
def fed_t2_outliers(spark, sf):
    m = cut(measurements_by_site(spark, sf).select("site", "l_orderkey", "l_linenumber", *VARS))  # three passes over one join
    stats = cov.pooled(cov.local_scatter(m, "site", VARS))
    found = cov.principal_components(stats.correlation)
    scored = m.select("site", "l_orderkey", "l_linenumber", *cov.score_columns(VARS, stats, found.loadings))
    names = [f"pc{i + 1}" for i in range(found.kept)]
    return cov.t2_outliers(scored, "site", names).where("outlier").select("site", "l_orderkey", "l_linenumber", F.round("t2", 6).alias("t2"))


BOX_SQL = f"SELECT site, min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_extendedprice) AS b0, max(l_extendedprice) AS b1 FROM ({SITE_SQL}) GROUP BY site"


@query(f"SELECT site, a0 AS min_quantity, a1 AS max_quantity, b0 AS min_price, b1 AS max_price, round((a1 - a0) * (b1 - b0), 4) AS volume FROM ({BOX_SQL})")
def fed_bounding_boxes(spark, sf):
    b = similarity.bounding_boxes(measurements_by_site(spark, sf), "site", ["l_quantity", "l_extendedprice"])
    return b.select("site", F.col("low")[0].alias("min_quantity"), F.col("high")[0].alias("max_quantity"), F.col("low")[1].alias("min_price"), F.col("high")[1].alias("max_price"), F.round("volume", 4).alias("volume"))


@query(
    f"""WITH b AS ({BOX_SQL}) SELECT x.site AS site_a, y.site AS site_b, round(CASE WHEN least(x.a1, y.a1) < greatest(x.a0, y.a0) OR least(x.b1, y.b1) < greatest(x.b0, y.b0) THEN 0
ELSE 2 * (least(x.a1, y.a1) - greatest(x.a0, y.a0)) * (least(x.b1, y.b1) - greatest(x.b0, y.b0)) / ((x.a1 - x.a0) * (x.b1 - x.b0) + (y.a1 - y.a0) * (y.b1 - y.b0)) END, 6) AS similarity FROM b x, b y"""
)
def fed_overlap_similarity(spark, sf):
    b = similarity.bounding_boxes(measurements_by_site(spark, sf), "site", ["l_quantity", "l_extendedprice"])
    return similarity.overlap_similarity(b, "site").withColumn("similarity", F.round("similarity", 6))


@query()
def fed_frechet_similarity(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("label").cast("string").alias("site"), doubles(F.col("embedding")).alias("v"))
    return similarity.frechet_matrix(cov.vector_scatter(vectors, "site", "v", 64)).select("site_a", "site_b", "similarity")


@query("SELECT l_suppkey, round(sum(l_quantity * l_discount) / sum(l_quantity), 6) AS l_discount, round(sum(l_quantity * l_tax) / sum(l_quantity), 6) AS l_tax FROM lineitem GROUP BY l_suppkey")
def fed_weighted_average(spark, sf):
    out = learning.weighted_average(table(spark, sf, "lineitem"), "l_quantity", ["l_discount", "l_tax"], ["l_suppkey"])
    return out.select("l_suppkey", F.round("l_discount", 6).alias("l_discount"), F.round("l_tax", 6).alias("l_tax"))


_COUNTS = "count(*) FILTER (WHERE toxic <> 1 AND quality <> 1) AS tn, count(*) FILTER (WHERE toxic <> 1 AND quality = 1) AS fp, count(*) FILTER (WHERE toxic = 1 AND quality <> 1) AS fn, count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS tp"


@query(
    f"""SELECT tn, fp, fn, tp, round(coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM (SELECT {_COUNTS} FROM labels)"""
)
def eval_confusion_metrics(spark, sf):
    m = learning.confusion(table(spark, sf, "labels"), "toxic", "quality")
    return m.select("tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("SELECT count(*) FILTER (WHERE toxic = 0) AS negatives, count(*) FILTER (WHERE toxic = 1) AS positives, round(count(*) FILTER (WHERE toxic = 0) / nullif(count(*) FILTER (WHERE toxic = 1), 0), 6) AS pos_weight FROM labels")
def eval_class_weights(spark, sf):
    w = learning.positive_weight(table(spark, sf, "labels"), "toxic")
    return w.withColumn("pos_weight", F.round("pos_weight", 6))


def _returned(spark, sf):
    rows = measurements_by_site(spark, sf)
    return rows.select("site", ((F.col("l_quantity") - 25) / 15).alias("q"), ((F.col("l_extendedprice") - 50_000) / 30_000).alias("p"), (F.col("l_extendedprice") > 50_000).cast("int").alias("y"))


def _rounds_sql(loss: str, rounds: int, rate: float, l1: float, l2: float) -> str:
    """Gradient steps, one after the other; sites weigh by their rows, so the means are those of all rows."""
    z = "(bias + wq * q + wp * p)"
    gap = f"(1 / (1 + exp(-{z})) - y)" if loss == "logistic" else f"(2 * ({z} - y))"
    steps = [f"s AS MATERIALIZED (SELECT (l_quantity - 25) / 15 AS q, (l_extendedprice - 50000) / 30000 AS p, CAST(l_extendedprice > 50000 AS INTEGER) AS y FROM ({SITE_SQL}))", "r0 AS (SELECT 0.0::DOUBLE AS bias, 0.0::DOUBLE AS wq, 0.0::DOUBLE AS wp)"]
    for i in range(rounds):
        step = [f"any_value(bias) - {rate} * avg({gap}) AS bias"] + [f"any_value({w}) - {rate} * (avg({gap} * {x}) + {l1} * sign(any_value({w})) + {2 * l2} * any_value({w})) AS {w}" for w, x in (("wq", "q"), ("wp", "p"))]
        steps.append(f"r{i + 1} AS MATERIALIZED (SELECT {', '.join(step)} FROM s, r{i})")
    terms = " UNION ALL ".join(f"SELECT '{n}' AS term, round({w}, 6) AS weight FROM r{rounds}" for n, w in (("bias", "bias"), ("q", "wq"), ("p", "wp")))
    return f"WITH {', '.join(steps)} {terms}"


@query(_rounds_sql("squared", 5, 0.2, 0.01, 0.05))
def fed_linear_rounds(spark, sf):
    rows = _returned(spark, sf).persist()
    model = learning.train_linear(rows, "site", ["q", "p"], "y", rounds=5, rate=0.2, l1=0.01, l2=0.05)
    out = [(n, round(v, 6)) for n, v in zip(("bias", "q", "p"), (model.bias, *model.weights))]
    rows.unpersist()
    return spark.createDataFrame(out, "term string, weight double")


@query(
    f"""WITH v AS (SELECT site, l_extendedprice > 50000 AS y, 0.5 + 0.25 * (l_extendedprice - 50000) / 30000 - 0.1 * (l_quantity - 25) / 15 AS z FROM ({SITE_SQL})), c AS (SELECT site, avg(pow(z - CAST(y AS INTEGER), 2)) AS mse, count(*) FILTER (WHERE y AND z > 0) AS tp,
count(*) FILTER (WHERE NOT y AND z > 0) AS fp, count(*) FILTER (WHERE y AND z <= 0) AS fn, count(*) AS n FROM v GROUP BY site)
SELECT site, round(mse, 6) AS mse, round((n - fp - fn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c"""
)
def eval_regression_scores(spark, sf):
    out = learning.regression_scores(_returned(spark, sf), ["q", "p"], "y", learning.Linear((-0.1, 0.25), 0.5), ["site"])
    return out.select("site", *[F.round(c, 6).alias(c) for c in ("mse", "accuracy", "precision", "recall", "f1")])


@query(_rounds_sql("logistic", 8, 2.0, 0.0, 0.0005))
def fed_logistic_rounds(spark, sf):
    rows = _returned(spark, sf).persist()
    model = learning.train_logistic(rows, "site", ["q", "p"], "y", rounds=8, rate=2.0)
    out = [(n, round(v, 6)) for n, v in zip(("bias", "q", "p"), (model.bias, *model.weights))]
    rows.unpersist()
    return spark.createDataFrame(out, "term string, weight double")


@query(
    f"""WITH s AS (SELECT site, (l_quantity - 25) / 15 AS q, (l_extendedprice - 50000) / 30000 AS p, l_extendedprice > 50000 AS y FROM ({SITE_SQL})),
v AS (SELECT 'price' AS model, site, y, p > 0 AS z FROM s UNION ALL SELECT 'quantity', site, y, q - 0.5 > 0 FROM s),
c AS (SELECT model, site, count(*) FILTER (WHERE y AND z) AS tp, count(*) FILTER (WHERE NOT y AND NOT z) AS tn, count(*) AS n FROM v GROUP BY model, site)
SELECT model, site, tp, tn, round((tp + tn) / n, 6) AS accuracy FROM c"""
)
def fed_cross_site_evaluation(spark, sf):
    models = {"price": learning.Linear((0.0, 1.0), 0.0), "quantity": learning.Linear((1.0, 0.0), -0.5)}
    out = learning.evaluate_across(_returned(spark, sf), "site", ["q", "p"], "y", models)
    return out.select("model", "site", "tp", "tn", F.round("accuracy", 6).alias("accuracy"))


@query(
    """WITH e AS (SELECT list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
p AS (SELECT CAST(i AS INTEGER) AS i, x[i + 1] AS a, x[(i + 1) % 64 + 1] AS b FROM e, (SELECT unnest(range(64)) AS i))
SELECT i AS "column", round(corr(a, b), 6) AS next_correlation, 64 AS n_components FROM p GROUP BY i"""
)
def fed_wide_components(spark, sf):
    """All components of the 64 values of the vectors; what they say of neighbouring columns is these columns' correlation."""
    found, loadings = wide.components(table(spark, sf, "embeddings"), "embedding", 1.0)
    sizes = F.array(*[F.lit(float(x) * 64) for x in found.explained])
    rows = cut(loadings)
    after = rows.select(((F.col("column") + 63) % 64).alias("column"), F.col("loading").alias("after"))
    terms = F.zip_with(F.zip_with("loading", "after", lambda a, b: a * b), sizes, lambda a, s: a * s)
    both = rows.join(after, "column").select("column", F.round(F.aggregate(terms, F.lit(0.0), lambda t, x: t + x), 6).alias("next_correlation"))
    return both.withColumn("n_components", F.lit(found.kept))


@query(
    """WITH g AS (SELECT CAST(event_id % 7 AS VARCHAR) AS round, CAST(user_id AS VARCHAR) AS site, ts, value FROM events WHERE event_type <> 'error'),
f AS (SELECT round, site, min(struct_pack(ts := ts, v := value)) AS r FROM g GROUP BY round, site),
p AS (SELECT round, site, r.ts AS came, r.v AS v, row_number() OVER (PARTITION BY round ORDER BY r.ts, site) AS place FROM f),
e AS (SELECT round, max(came) FILTER (WHERE place = 5) + INTERVAL 600 SECOND AS closed FROM p GROUP BY round)
SELECT p.round, site, CAST(place AS INTEGER) AS place, v AS payload, date_diff('microsecond', came, closed) AS left_us FROM p JOIN e ON p.round = e.round AND came <= closed"""
)
def fed_gather(spark, sf):
    """The first good reply of each user to each round, five at least, until ten minutes after the fifth."""
    e = table(spark, sf, "events")
    replies = e.select((F.col("event_id") % 7).alias("round"), F.col("user_id").alias("site"), F.when(F.col("event_type") != "error", "OK").otherwise("ERROR").alias("status"), F.col("ts").cast("timestamp").alias("at"), "value")
    out = gather.gather(replies, 5, 600, payload="value")
    return out.select("round", "site", "place", F.col("payload").cast("double").alias("payload"), (F.unix_micros("closed_at") - F.unix_micros("at")).alias("left_us"))
