"""Profiles, catalog and text queries, and extensions: windows over events, grouping sets, set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from caresieve.functions import text
from caresieve.operators import etl, images, joins, prepare, profile, quality
from caresieve.plans.register import registrar
from caresieve.sources import files, sinks
from caresieve.sources.tables import table
from caresieve.streaming import incremental

QUERIES: dict = {}
ORACLE: dict = {}
query = registrar(QUERIES, ORACLE)

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS valid, count(*) - count({c}) AS missing, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3, max({c}) AS max FROM lineitem"
        for c in _NUMBERS
    )
)
def profile_table(spark, sf):
    out = profile.profile(table(spark, sf, "lineitem"), list(_NUMBERS)).drop("type")
    return out.select("variable", "valid", "missing", *[F.round(c, 4).alias(c) for c in ("mean", "sd")], "min", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "max")


@query(
    "WITH c AS (SELECT 'l_returnflag' AS variable, l_returnflag AS level, count(*) AS n FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem GROUP BY 2) SELECT variable, level, n, CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, level) AS INTEGER) AS rank FROM c QUALIFY rank <= 5"
)
def profile_frequent_values(spark, sf):
    return profile.frequent_values(table(spark, sf, "lineitem"), ["l_returnflag", "l_suppkey"], 5)


@query("SELECT count(*) AS unique_ids, count(*) FILTER (WHERE n > 1) AS replicated_ids, CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def profile_replicates(spark, sf):
    return profile.replicate_statistics(table(spark, sf, "orders"), "o_custkey")


@query("SELECT p_partkey AS concept_id, p_name || ' \"' || p_brand AS concept_name, p_type AS concept_class_id, DATE '2024-02-29' AS valid_start_date FROM part")
def catalog_vocabulary_scan(spark, sf):
    lines = table(spark, sf, "part").select(F.concat_ws("\t", "p_partkey", F.concat("p_name", F.lit(' "'), "p_brand"), "p_type", F.lit("20240229")).alias("value"))
    return files.vocabulary_rows(lines, "concept_id bigint, concept_name string, concept_class_id string, valid_start_date date")


@query("SELECT s_name, CAST(nullif(regexp_extract(s_name, '(\\d+)', 1), '') AS BIGINT) AS number FROM supplier")
def str_natural_sort_key(spark, sf):
    return table(spark, sf, "supplier").select("s_name", text.numeric_order(F.col("s_name")).alias("number"))


@query(r"SELECT page_id, regexp_extract(regexp_replace(url, '[/\\]+$', ''), '[^/\\]*$') AS base FROM pages")
def str_base_name(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.base_name(F.col("url")).alias("base"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) ELSE 'x' || s_suppkey END AS key FROM supplier")
def str_number_key(spark, sf):
    padded = F.when(F.col("s_suppkey") % 2 == 0, F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).otherwise(F.concat(F.lit("x"), F.col("s_suppkey")))
    return table(spark, sf, "supplier").select("s_suppkey", text.number_key(padded).alias("key"))


@query("SELECT r_regionkey || ';' || r_name AS value FROM region UNION ALL SELECT 'r_regionkey;r_name' UNION ALL SELECT ';code'")
def sink_two_headers(spark, sf):
    return sinks.two_header_lines(table(spark, sf, "region").select("r_regionkey", "r_name"), {"r_name": "code"}).select("value")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def ext_windowed_counts(spark, sf):
    out = incremental.windowed_counts(table(spark, sf, "events"), "ts", "event_type", "value")
    return out.withColumn("total", F.round("total", 4))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events),
s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts, b) AS k FROM g) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k"""
)
def ext_sessions(spark, sf):
    return incremental.sessions(table(spark, sf, "events"), "ts", "user_id")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def ext_cube(spark, sf):
    return table(spark, sf, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_orderkey, CAST(rank() OVER w AS INTEGER) AS place, lag(o_orderkey) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def ext_rank_lag(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", F.rank().over(w).alias("place"), F.lag("o_orderkey").over(w).alias("before"))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def ext_intersect(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf, "orders").select("o_custkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def ext_except(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf, "orders").select("o_custkey"))


@query("SELECT count(*) AS n, CAST(1000 AS BIGINT) AS expected, count(*) <> 1000 AS present FROM customer")
def dq_patient_total(spark, sf):
    return quality.patient_total(table(spark, sf, "customer"), 1000)


@query("SELECT k, CAST(max(c) AS INTEGER) AS clinical, CAST(max(i) AS INTEGER) AS image, CAST(max(g) AS INTEGER) AS genomic FROM (SELECT o_custkey AS k, 1 AS c, 0 AS i, 0 AS g FROM orders UNION ALL SELECT user_id, 0, 1, 0 FROM events UNION ALL SELECT c_custkey, 0, 0, 1 FROM customer WHERE c_acctbal > 0) GROUP BY k")
def dq_patients_list(spark, sf):
    t = lambda n: table(spark, sf, n)
    return quality.patients_list(t("orders").select(F.col("o_custkey").alias("k")), t("events").select(F.col("user_id").alias("k")), t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query(
    """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) AS r, count(*) OVER () AS n FROM orders),
a AS (SELECT o_orderkey, r <= floor(n * 0.4) AS rest FROM o), b AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('8:' || o_orderkey), o_orderkey) AS r, count(*) OVER () AS n FROM a WHERE rest)
SELECT o_orderkey, 'train' AS split FROM a WHERE NOT rest UNION ALL SELECT o_orderkey, CASE WHEN r <= floor(n * 0.5) THEN 'test' ELSE 'validation' END FROM b"""
)
def prep_nested_split(spark, sf):
    return prepare.nested_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 7, 0.6, 0.5)


@query("SELECT l_orderkey AS k, CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS BIGINT) AS n_right, CAST(count(*) FILTER (WHERE l_returnflag <> 'A') AS BIGINT) AS n_wrong FROM lineitem GROUP BY 1 HAVING n_wrong > 0 OR n_right < 1 OR n_right > 2")
def structure_file_counts(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.concat(F.lit("f."), F.col("l_returnflag")).alias("name"))
    return images.file_count_faults(rows, ["k"], "name", ".a", 1, 2)


@query(
    """WITH p AS (SELECT DISTINCT o_custkey AS k FROM orders), n AS (SELECT p.k, count(c_mktsegment) AS n, count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS bad FROM p LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON k = c_custkey GROUP BY p.k)
SELECT 'E2301' AS code, k FROM n WHERE n <> 1 UNION ALL SELECT 'E2302', k FROM n WHERE bad > 0"""
)
def structure_patient_labels(spark, sf):
    labels = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label"))
    return images.patient_label_faults(labels, table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), "k", "label", ["BUILDING", "MACHINERY"])


@query(
    """WITH s AS (SELECT l_orderkey AS k, l_linenumber AS i, l_extendedprice AS z FROM lineitem), m AS (SELECT k, i, CASE WHEN k % 9 = 0 THEN z + 1 ELSE z END AS z FROM s),
a AS (SELECT k, round(z, 5) AS z, row_number() OVER (PARTITION BY k ORDER BY z) AS p FROM s), b AS (SELECT k, round(z, 5) AS z, row_number() OVER (PARTITION BY k ORDER BY z) AS p FROM m)
SELECT DISTINCT a.k FROM a JOIN b ON a.k = b.k AND a.p = b.p WHERE abs(a.z - b.z) > 0.0001"""
)
def structure_slice_positions(spark, sf):
    s = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("z"))
    return images.position_faults(s, s.withColumn("z", F.when(F.col("k") % 9 == 0, F.col("z") + 1).otherwise(F.col("z"))), ["k"], "z")


@query(
    """WITH l AS (SELECT l_orderkey AS k, l_linenumber AS name, l_returnflag AS label FROM lineitem WHERE l_linenumber <= 5), s AS (SELECT l_orderkey AS k, l_linenumber AS name FROM lineitem WHERE l_linenumber <> 3),
a AS (SELECT k, count(*) AS n, count(*) FILTER (WHERE label NOT IN ('A', 'N')) AS bad FROM l GROUP BY k), b AS (SELECT k, count(*) AS m FROM s GROUP BY k), u AS (SELECT DISTINCT k FROM l WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = l.k AND s.name = l.name))
SELECT 'E2203' AS code, a.k FROM a LEFT JOIN b ON a.k = b.k WHERE n IS DISTINCT FROM m UNION ALL SELECT 'E2204', k FROM u UNION ALL SELECT 'E2205', k FROM a WHERE bad > 0"""
)
def structure_slice_labels(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("name"), F.col("l_returnflag").alias("label"))
    return images.slice_label_faults(rows.where("name <= 5"), rows.where("name <> 3").drop("label"), ["k"], "name", "label", ["A", "N"])


@query("SELECT o_custkey AS person, 500 + row_number() OVER (ORDER BY o_custkey, o_orderkey, 'f' || o_orderkey) AS genomic_result_id, 'f' || o_orderkey AS filename FROM orders")
def etl_genomic_rows(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample"), F.col("o_custkey").alias("person"))
    samples = o.select("sample", F.concat(F.lit("f"), F.col("sample")).alias("path"))
    return etl.genomic_rows(samples, o, "person", "sample", 500).select("person", "genomic_result_id", "filename")


@query(
    """WITH f AS (SELECT l_orderkey AS procedure_occurrence_id, string_agg('f' || l_linenumber, ',' ORDER BY 'f' || l_linenumber) AS files, string_agg('m' || l_linenumber, ',' ORDER BY 'm' || l_linenumber) FILTER (WHERE l_linenumber > 3) AS masks FROM lineitem GROUP BY 1)
SELECT row_number() OVER (ORDER BY procedure_occurrence_id) AS image_occurrence_id, procedure_occurrence_id, files, masks FROM f"""
)
def etl_image_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("s"), "l_linenumber")
    paths = rows.select("s", F.concat(F.lit("f"), F.col("l_linenumber")).alias("path"))
    masks = rows.where("l_linenumber > 3").select("s", F.concat(F.lit("m"), F.col("l_linenumber")).alias("path"))
    procedures = rows.select("s").distinct().withColumn("procedure_occurrence_id", F.col("s"))
    out = etl.image_rows(paths, masks, procedures, ["s"])
    return out.select("image_occurrence_id", "procedure_occurrence_id", F.array_join("filename", ",").alias("files"), F.array_join("mask_filename", ",").alias("masks"))


@query("SELECT vec_id, round(list_sum(y), 4) + 0.0 AS total, round(y[1], 4) + 0.0 AS first FROM (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CASE WHEN vec_id % 2 = 0 THEN 1 ELSE 0 END) AS y FROM embeddings)")
def tensor_masked(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("pixels"))
    e = e.withColumn("mask", F.transform("pixels", lambda v: F.when(F.col("vec_id") % 2 == 0, 255).otherwise(0)))
    out = images.masked(e)
    return out.select("vec_id", (F.round(F.aggregate("pixels", F.lit(0.0), lambda a, v: a + v), 4) + 0.0).alias("total"), (F.round(F.element_at("pixels", 1), 4) + 0.0).alias("first"))  # no -0


@query("SELECT vec_id, round(embedding[8], 5) AS first, round(embedding[57], 5) AS last FROM embeddings")
def tensor_reorient(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.lit(8).alias("h"), F.lit(8).alias("w"), F.col("embedding").alias("pixels"), F.lit("r").alias("flips"))
    out = images.to_lps(e)
    return out.select("vec_id", F.round(F.element_at("pixels", 1), 5).alias("first"), F.round(F.element_at("pixels", 64), 5).alias("last"))


@query(
    f"""WITH v AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), c AS (SELECT label, quantile_cont(v, [{', '.join(str(round(0.95 + i / 10_000, 4)) for i in range(500))}]) AS y FROM v GROUP BY label),
u AS (SELECT label, y[i] AS yi, i, (i - 1) / 499 - (y[i] - y[1]) / (y[500] - y[1]) AS d FROM c, (SELECT unnest(range(1, 501)) AS i)), k AS (SELECT label, arg_max(yi, round(d, 12) - i * 1e-13) AS top FROM u GROUP BY label)
SELECT vec_id, round(least(list_max(embedding), top), 5) AS top FROM embeddings JOIN k USING (label)"""
)
def tensor_knee_clip(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("pixels"))
    return images.knee_clip(e, ["label"]).select("vec_id", F.round(F.array_max("pixels"), 5).alias("top"))


@query(
    """WITH b AS (SELECT vec_id % 4 AS segment, vec_id // 4 AS slice, list_transform(embedding, lambda v: v > CAST(0.1 AS DOUBLE)) AS p FROM embeddings), e AS (SELECT * FROM b UNION ALL SELECT 9, slice, p FROM b WHERE segment = 1),
l AS (SELECT segment, p, row_number() OVER (PARTITION BY segment ORDER BY slice) - 1 AS i, count(*) OVER (PARTITION BY segment) AS m FROM e WHERE list_bool_or(p)),
w AS (SELECT segment, list(p ORDER BY i) AS w FROM l WHERE abs(i - m // 2) <= 5 GROUP BY segment) SELECT count(*) AS n, string_agg(segment, ',' ORDER BY segment) AS masks FROM w GROUP BY w HAVING count(*) > 1"""
)
def mask_replicate_windows(spark, sf):
    e = table(spark, sf, "embeddings").select(F.lit("s").alias("series"), (F.col("vec_id") % 4).alias("segment"), F.floor(F.col("vec_id") / 4).alias("slice"), F.transform("embedding", lambda v: (v > 0.1).cast("int")).alias("pixels"))
    copy = e.where("segment = 1").withColumn("segment", F.lit(9))
    return images.mask_replicates(e.unionByName(copy), ["series"], "segment", "slice").select("n", F.array_join(F.transform("masks", lambda x: x.cast("string")), ",").alias("masks"))


_INSTANCES = "SELECT l_suppkey AS k, (l_partkey + l_linenumber) % 40 // 8 AS t, CASE WHEN l_linenumber = 7 THEN 5 WHEN l_orderkey % 23 = 0 THEN -1 ELSE (l_partkey + l_linenumber) % 40 // 8 END AS p FROM lineitem"
_CELLS = f"""WITH x AS ({_INSTANCES}), s AS (SELECT k, t, p, count(*) OVER (PARTITION BY k, t) AS st, count(*) OVER (PARTITION BY k, p) AS sp FROM x),
f AS (SELECT k, CASE WHEN st < 3 THEN -1 ELSE t END AS t, CASE WHEN sp < 3 THEN -1 ELSE p END AS p FROM s), c AS (SELECT k, t, p, count(*) AS n FROM f GROUP BY ALL),
d AS (SELECT *, sum(n) OVER (PARTITION BY k, t) AS nt, sum(n) OVER (PARTITION BY k, p) AS np, row_number() OVER (PARTITION BY k, p ORDER BY n DESC, t) AS r FROM c),
o AS (SELECT k, t, n / (nt + np - n) AS iou FROM d WHERE r = 1 AND p <> -1), h AS (SELECT k, t, lim, iou > lim AS hit FROM o, (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9]) AS lim)),
q AS (SELECT k, lim, count(*) FILTER (WHERE hit AND t <> -1) AS tp, count(*) - count(*) FILTER (WHERE hit AND t = -1) AS np, count(DISTINCT CASE WHEN hit AND t <> -1 THEN t END) AS fd FROM h GROUP BY k, lim),
g AS (SELECT k, count(DISTINCT t) AS n_t FROM f WHERE t <> -1 GROUP BY k), z AS (SELECT q.k, lim, coalesce(tp / nullif(tp + coalesce(n_t, 0) - fd, 0), 0) AS r, coalesce(tp / nullif(np, 0), 0) AS p FROM q LEFT JOIN g ON q.k = g.k),
e AS (SELECT k, lim, r, p FROM z UNION ALL SELECT DISTINCT k, 2.0, 1.0, 0.0 FROM z), m AS (SELECT k, r - coalesce(lag(r) OVER w, 0) AS step, max(p) OVER (PARTITION BY k ORDER BY r, lim ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p FROM e WINDOW w AS (PARTITION BY k ORDER BY r, lim))"""


@query(f"{_CELLS} SELECT k, round(sum(step * p), 6) AS average_precision FROM m GROUP BY k")
def mask_average_precision(spark, sf):
    """A supplier's lines as an image: lines are pixels, and instances come from their parts."""
    label = F.floor((F.col("l_partkey") + F.col("l_linenumber")) % 40 / 8)
    wrong = F.when(F.col("l_linenumber") == 7, 5).when(F.col("l_orderkey") % 23 == 0, -1).otherwise(label)
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), label.alias("t"), wrong.alias("p"))
    return images.average_precision(rows, "t", "p", -1, 3, ["k"]).withColumn("average_precision", F.round("average_precision", 6))


@query(
    """WITH f AS (SELECT DISTINCT o_custkey AS k FROM orders), c AS (SELECT l_suppkey AS k, count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber = 6) AS n FROM lineitem GROUP BY 1)
SELECT 'E2201' AS code, f.k, coalesce(n, 0) AS n_files FROM f LEFT JOIN c ON f.k = c.k WHERE coalesce(n, 0) <> 1"""
)
def structure_label_files(spark, sf):
    names = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 6), "labels.CSV").otherwise("slice.dcm")
    found = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), names.alias("name"))
    return images.label_file_faults(table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), found, ["k"], "name")


@query("SELECT 'E2202' AS code, l_orderkey AS k, max(CASE WHEN l_linestatus = 'O' THEN 3 ELSE 2 END) AS n_columns FROM lineitem GROUP BY 2 HAVING n_columns <> 2")
def structure_label_tables(spark, sf):
    row = F.concat_ws(";", F.concat(F.lit("slice"), F.col("l_linenumber")), F.lit("x"), F.when(F.col("l_linestatus") == "O", "more"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("place"), row.alias("line"))
    return images.label_table_faults(lines, ["k"])


@query("SELECT 'E001' AS code, 'images' AS part UNION ALL SELECT 'E002', 'clinical' WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_name = 'table.csv') UNION ALL SELECT 'E006', 'genomics' WHERE (SELECT count(*) FROM orders) = 0")
def structure_input_faults(spark, sf):
    """Customers lie in the clinical folder, orders are genomic samples, and there are no images."""
    clinical = table(spark, sf, "customer").select(F.concat(F.lit("clinical/"), F.col("c_name")).alias("path"))
    samples = table(spark, sf, "orders").select(F.concat(F.lit("genomics/sample_"), F.col("o_orderkey"), F.lit(".json")).alias("path"))
    mapping = spark.createDataFrame([("genomics/mapping.csv",)], "path string")
    return quality.input_faults(clinical.unionByName(samples).unionByName(mapping), {"clinical": "table.csv", "images": "", "genomics": "mapping.csv"})


@query(
    "SELECT CASE WHEN c_mktsegment = 'MACHINERY' OR c_custkey % 7 = 0 THEN 'W3301' ELSE 'E3301' END AS code, c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' OR c_custkey % 7 = 0 OR c_mktsegment <> 'BUILDING' OR c_nationkey > 20"
)
def structure_view_faults(spark, sf):
    c = table(spark, sf, "customer")
    flat = c.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "L").when(F.col("c_mktsegment") == "MACHINERY", " ").otherwise("R").alias("patient_orientation"), F.when(F.col("c_custkey") % 7 != 0, F.when(F.col("c_nationkey") > 20, "PA").otherwise("AP")).alias("view_position"))
    return images.view_faults(flat, ["c_custkey"], "L", "AP")


@query("SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' UNION SELECT user_id FROM events WHERE event_type = 'purchase' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def cohort_removal_union(spark, sf):
    t = lambda n: table(spark, sf, n)
    return images.removal_union(t("orders").where("o_orderpriority = '1-URGENT'").select("o_custkey"), t("events").where("event_type = 'purchase'").select("user_id"), t("customer").where("c_acctbal < 0").select("c_custkey"))


@query(
    """WITH f AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS TIMESTAMP) AS ts, max(o_orderkey) AS o FROM orders GROUP BY 1, 2)
SELECT event_id, e.user_id, f.o AS o_orderkey FROM events e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.ts"""
)
def ext_asof_join(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    facts = table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("timestamp").alias("ts"), "o_orderkey")
    return joins.asof_join(rows, facts, ["user_id"], "ts", ["o_orderkey"]).drop("ts")


@query("SELECT l_orderkey, l_linenumber, l_quantity, n_nationkey FROM lineitem JOIN nation ON l_quantity >= n_nationkey * 2 AND l_quantity < n_nationkey * 2 + n_regionkey + 1.5")
def ext_interval_join(spark, sf):
    spans = table(spark, sf, "nation").select("n_nationkey", (F.col("n_nationkey") * 2.0).alias("low"), (F.col("n_nationkey") * 2 + F.col("n_regionkey") + 1.5).alias("high"))
    points = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.interval_join(points, spans, "l_quantity", "low", "high", 3.0).drop("low", "high")


@query("SELECT c_custkey, o_orderkey, o_totalprice FROM (SELECT * FROM orders WHERE o_orderstatus = 'P') o RIGHT JOIN customer ON o_custkey = c_custkey")
def ext_right_join(spark, sf):
    """Every customer with their open orders, if there are any: the right side is kept whole."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'").select("o_custkey", "o_orderkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "right").select("c_custkey", "o_orderkey", "o_totalprice")


@query("SELECT e.event_id, t.k, CAST(t.v AS INTEGER) AS v FROM events e, LATERAL (SELECT unnest(json_keys(e.props)) AS k, json_extract_string(e.props, '$.' || unnest(json_keys(e.props))) AS v) t")
def ext_lateral_join(spark, sf):
    """Every event with the fields of its JSON, by a lateral join."""
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    fields = spark.tvf.explode(F.col("m").outer()).toDF("k", "v")
    return e.lateralJoin(fields).select("event_id", "k", "v")
