"""Checks and transforms of series, masks and ground truths over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresieve.functions import arrays as A
from caresieve.operators import covariance, etl, images, learning, losses, prepare, quality
from caresieve.operators.spec import Protocol, Variable
from caresieve.plans.register import registrar
from caresieve.sources.tables import measurements_by_site, table

QUERIES: dict = {}
ORACLE: dict = {}
query = registrar(QUERIES, ORACLE)

_X = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"


def _slices(spark, sf):
    """Vectors as slices of patients (ten each) and series (five each)."""
    e = table(spark, sf, "embeddings")
    return e.select(
        F.floor(F.col("vec_id") / 10).cast("string").alias("patient_id"), F.floor(F.col("vec_id") / 5).cast("string").alias("series_id"), F.col("vec_id").cast("int").alias("slice_idx"),
        F.when(F.col("vec_id") % 7 == 0, 4).otherwise(8).alias("h"), F.when(F.col("vec_id") % 7 == 0, 16).when(F.col("vec_id") % 9 == 0, 7).otherwise(8).alias("w"),
        F.when(F.col("label") == 3, "CT").when(F.col("label") == 4, None).otherwise("MR").alias("modality"), A.doubles(F.col("embedding")).alias("pixels"),
    )


@query(
    """WITH s AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 4 ELSE 8 END AS h, CASE WHEN vec_id % 7 = 0 THEN 16 WHEN vec_id % 9 = 0 THEN 7 ELSE 8 END AS w, CASE label WHEN 3 THEN 'CT' WHEN 4 THEN NULL ELSE 'MR' END AS m FROM embeddings)
SELECT 'E3101' AS code, CAST(vec_id AS INTEGER) AS slice_idx FROM s WHERE m <> 'MR' UNION ALL SELECT 'E3201', CAST(vec_id AS INTEGER) FROM s WHERE h * w <> 64 UNION ALL SELECT 'E3501', CAST(vec_id AS INTEGER) FROM s WHERE h < 8 OR w < 8"""
)
def structure_slice_faults(spark, sf):
    """E3101, E3201 and E3501: slices of another modality, of a wrong size, and too small ones."""
    return images.slice_checks(_slices(spark, sf), 8, 8, "MRI").select("code", "slice_idx")


@query("SELECT CAST(vec_id // 5 AS VARCHAR) AS series_id, count(DISTINCT CASE WHEN vec_id % 7 = 0 THEN 1 WHEN vec_id % 9 = 0 THEN 2 ELSE 3 END) AS n_shapes FROM embeddings GROUP BY 1 HAVING n_shapes > 1")
def structure_mask_shapes(spark, sf):
    """E4501: series whose masks differ in shape."""
    return images.shape_faults(_slices(spark, sf), ["series_id"])


@query("SELECT DISTINCT CAST(vec_id // 10 AS VARCHAR) AS patient_id, first_value(CAST(vec_id // 5 AS VARCHAR)) OVER (PARTITION BY vec_id // 10 ORDER BY CAST(vec_id // 5 AS VARCHAR)) AS series_id, count(*) OVER (PARTITION BY vec_id // 10, vec_id // 5) AS n FROM embeddings QUALIFY series_id = CAST(vec_id // 5 AS VARCHAR)")
def structure_first_series(spark, sf):
    """The slices of each patient's first series."""
    return images.first_series(_slices(spark, sf)).groupBy("patient_id", "series_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH s AS (SELECT vec_id, vec_id // 5 AS series, (vec_id * 3) % 5 AS z FROM embeddings), p AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY z, vec_id) AS place, coalesce(lag(z) OVER (PARTITION BY series ORDER BY vec_id) > z, false) AS back FROM s)
SELECT CAST(vec_id AS INTEGER) AS slice_idx, CAST(place AS INTEGER) AS place, bool_or(back) OVER (PARTITION BY series) AS reordered FROM p"""
)
def structure_slice_order(spark, sf):
    """Slices by z, and which series come out of that order."""
    rows = _slices(spark, sf).withColumn("z", (F.col("slice_idx") * 3 % 5).cast("double"))
    return images.order_slices(rows, ["series_id"]).select("slice_idx", "place", "reordered")


@query(
    f"""WITH s AS (SELECT vec_id, CASE WHEN vec_id % 6 = 1 THEN list_transform({_X}, lambda v: 1.0) ELSE {_X} END AS x FROM embeddings), q AS (SELECT vec_id, x, (SELECT quantile_cont(v, [0.001, 0.999]) FROM (SELECT unnest(x) AS v)) AS q FROM s),
c AS (SELECT vec_id, list_transform(x, lambda v: least(greatest(v, q[1]), q[2])) AS y FROM q)
SELECT CAST(vec_id AS INTEGER) AS slice_idx, list_max(y) = list_min(y) AS discarded, CASE WHEN list_max(y) > list_min(y) THEN round(list_sum(list_transform(y, lambda v: (v - list_min(y)) / (list_max(y) - list_min(y)))), 4) END AS total FROM c"""
)
def tensor_pipeline(spark, sf):
    """Slices clipped and scaled as their modality asks; constant ones are discarded."""
    rows = _slices(spark, sf).withColumn("pixels", F.when(F.col("slice_idx") % 6 == 1, F.transform("pixels", lambda v: F.lit(1.0))).otherwise(F.col("pixels")))
    return images.normalise(rows, "MRI").select("slice_idx", "discarded", F.round(A.total(F.col("pixels")), 4).alias("total"))


@query(
    """WITH v AS (SELECT vec_id // 10 AS patient, vec_id % 10 AS place, CASE label % 4 WHEN 0 THEN 'liver' WHEN 1 THEN 'tumour' WHEN 2 THEN 'liver' ELSE 'air' END AS name FROM embeddings)
SELECT DISTINCT patient, place, CASE name WHEN 'liver' THEN 1 ELSE 2 END AS label FROM v WHERE name <> 'air'"""
)
def mask_unite_segments(spark, sf):
    """Segments of one name as one; names without a code go."""
    name = F.element_at(F.array(*[F.lit(x) for x in ("liver", "tumour", "liver", "air")]), F.col("label") % 4 + 1)
    rows = table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("patient"), (F.col("vec_id") % 10).alias("place"), name.alias("name"))
    return images.unite_segments(rows, ["patient"], ["place"], "name", {"liver": 1, "tumour": 2})


@query("SELECT CAST(vec_id // 5 AS VARCHAR) AS series_id, CAST(vec_id % 5 AS INTEGER) AS slice_idx FROM embeddings WHERE (vec_id // 5 + vec_id % 5) % 3 <> 0")
def mask_drop_slices(spark, sf):
    """Masks without the slices that a list, counting from 1, discards."""
    rows = table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 5).cast("string").alias("series_id"), (F.col("vec_id") % 5).cast("int").alias("slice_idx"))
    gone = rows.where((F.floor(F.col("series_id").cast("long")) + F.col("slice_idx")) % 3 == 0).select("series_id", (F.col("slice_idx") + 1).alias("discarded_slice"))
    return images.drop_slices(rows, gone, ["series_id"])


@query(
    """WITH r AS (SELECT label AS t, CASE WHEN vec_id % 3 = 0 THEN (label + 1) % 10 ELSE label END AS p FROM embeddings WHERE label <> 9),
c AS (SELECT c, (SELECT count(*) FROM r WHERE t = c AND p = c) AS i, (SELECT count(*) FROM r WHERE t = c OR p = c) AS u FROM (SELECT unnest(range(1, 10)) AS c)) SELECT round(avg(coalesce(i / nullif(u, 0), 0)), 9) AS mean_iou FROM c"""
)
def mask_mean_iou(spark, sf):
    """Mean intersection over union of nine classes, the first being skipped and the last ignored."""
    rows = table(spark, sf, "embeddings").select("label", F.when(F.col("vec_id") % 3 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("p"))
    return images.mean_iou(rows, "label", "p", 10, ignore=9, skip=(0,)).select(F.round("mean_iou", 9).alias("mean_iou"))


@query("WITH n AS (SELECT o_orderstatus AS l, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT count(*) FILTER (WHERE 100 * (1 - 3 * n / (SELECT sum(n) FROM n)) >= 30) AS bad FROM n) SELECT 'W902' AS code, bad AS n, bad > 0 AS present FROM b")
def dq_truth_imbalance(spark, sf):
    """W902: levels of a ground truth that are far from their even share."""
    truth = Variable("o_orderstatus", "str", 1, cardinality=3, levels=("F", "O", "P"), unbalance=("<30%",), ground_truth=True)
    return quality.ground_truth_checks(table(spark, sf, "orders"), truth)


@query("SELECT 'W903' AS code, CAST(NULL AS BIGINT) AS n, NOT 100 * stddev_samp(o_totalprice) / avg(o_totalprice) < 40 AS present FROM orders")
def dq_truth_variability(spark, sf):
    """W903: a continuous ground truth whose variability is out of bounds."""
    truth = Variable("o_totalprice", "float", 1, variability=("<40%",), ground_truth=True)
    return quality.ground_truth_checks(table(spark, sf, "orders"), truth)


@query(
    """WITH s AS (SELECT r_name AS site, m.name AS model, CASE WHEN m.name = 'a' THEN l_quantity > 20 WHEN m.name = 'b' THEN l_discount > 0.05 ELSE l_tax > 0.02 END = (l_returnflag = 'R') AS hit FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, (VALUES ('a'), ('b'), ('c')) m(name)),
m AS (SELECT model, avg(a) AS accuracy FROM (SELECT model, site, avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END) AS a FROM s GROUP BY ALL) GROUP BY model) SELECT model, round(accuracy, 9) AS accuracy FROM m ORDER BY m.accuracy DESC, model LIMIT 1"""
)
def eval_best_model(spark, sf):
    """The model whose mean accuracy over the sites is best."""
    rows = measurements_by_site(spark, sf).select("site", (F.col("l_returnflag") == "R").alias("y"), F.inline(F.array(*[F.struct(F.lit(k).alias("model"), t.alias("p")) for k, t in (("a", F.col("l_quantity") > 20), ("b", F.col("l_discount") > 0.05), ("c", F.col("l_tax") > 0.02))])))
    scores = rows.groupBy("model", "site").agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"))
    return learning.best_model(scores).select("model", F.round("accuracy", 9).alias("accuracy"))


@query(
    """WITH r AS (SELECT o_totalprice / 100000 AS t, o_totalprice / 100000 + (o_orderkey % 7 - 3) * 0.5 AS p, o_orderkey % 3 AS c, [0.2, 0.3, 0.5] AS q FROM orders)
SELECT round(avg(CASE WHEN abs(t - p) < 1 THEN (t - p) * (t - p) / 2 ELSE abs(t - p) - 0.5 END), 6) AS smooth, round(sum(-([1.0, 2.0, 0.5])[c + 1] * ln(q[c + 1])) / sum(([1.0, 2.0, 0.5])[c + 1]), 6) AS weighted FROM r"""
)
def loss_smooth_and_weighted(spark, sf):
    """Smooth L1, and cross entropy by class weights."""
    t = F.col("o_totalprice") / 100000
    rows = table(spark, sf, "orders").select(t.alias("t"), (t + (F.col("o_orderkey") % 7 - 3) * 0.5).alias("p"), (F.col("o_orderkey") % 3).cast("int").alias("c"), F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5)).alias("q"))
    smooth, weighted = losses.smooth_l1(rows, "t", "p"), losses.weighted_cross_entropy(rows, "c", "q", [1.0, 2.0, 0.5])
    return smooth.select(F.round("loss", 6).alias("smooth")).crossJoin(weighted.select(F.round("loss", 6).alias("weighted")))  # single rows


@query(
    """WITH l AS (SELECT 'o_orderpriority' AS variable, 2 AS i, o_orderpriority AS level FROM orders UNION SELECT 'o_orderstatus', 1, o_orderstatus FROM orders)
SELECT variable, printf('V%03d', i) AS variable_code, level, printf('V%03d.%02d', i, row_number() OVER (PARTITION BY variable ORDER BY level)) AS level_code FROM l UNION ALL SELECT 'o_totalprice', 'V003', NULL, NULL"""
)
def prep_observed_code_map(spark, sf):
    """Codes of variables and of the levels that their column holds."""
    return prepare.observed_code_map(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority", "o_totalprice"], ["o_orderstatus", "o_orderpriority"])


_BALANCE = {"Tabella_target": "MEASUREMENT", "Voce_tabella_target": "measurement_concept_id", "Concept_ID": 77, "Voce_valore_target": "value_as_number", "Voce_tabella_sorgente": "measurement_source_value", "Voce_valore_sorgente": "value_source_value", "Voce_unità_target": "unit_concept_id", "Voce_unità_sorgente": "unit_source_value"}
_SEGMENT = {"Tabella_target": "MEASUREMENT", "Voce_tabella_target": "measurement_concept_id", "Concept_ID": 78, "Voce_valore_target": "value_as_concept_id", "Voce_tabella_sorgente": "measurement_source_value"}


@query(
    """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS b, c_mktsegment AS s FROM customer)
SELECT c_custkey, CAST(77 AS BIGINT) AS measurement_concept_id, 'balance' AS measurement_source_value, b AS value_as_number, CAST(9000 AS BIGINT) AS unit_concept_id, 'euro' AS unit_source_value, CAST(NULL AS BIGINT) AS value_as_concept_id FROM c WHERE b IS NOT NULL
UNION ALL SELECT c_custkey, 78, 'segment', NULL, NULL, NULL, CASE s WHEN 'BUILDING' THEN 501 WHEN 'MACHINERY' THEN 502 END FROM c WHERE s IN ('BUILDING', 'MACHINERY')"""
)
def etl_target_rows(spark, sf):
    """Measurements as the variables' ETL entries map them: fields, concepts and units."""
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("balance"), F.col("c_mktsegment").alias("segment"))
    variables = [Variable("balance", "float", 1, unit="euro", unit_concept_id=9000, target=_BALANCE), Variable("segment", "str", 2, cardinality=2, levels=("BUILDING", "MACHINERY"), concept_ids=(501, 502), target=_SEGMENT)]
    return etl.target_rows(c, variables, "MEASUREMENT", ["c_custkey"]).drop("value_source_value")


@query("SELECT c_custkey, CAST(2024 - (20 + c_custkey % 60) AS INTEGER) AS year_of_birth, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 501 WHEN 'MACHINERY' THEN 502 END AS BIGINT) AS gender_concept_id, c_mktsegment AS gender_source_value FROM customer")
def etl_target_persons(spark, sf):
    """Persons as the variables' ETL entries map them: a year from an age, a concept from a level, and its source."""
    c = table(spark, sf, "customer").select("c_custkey", (20 + F.col("c_custkey") % 60).alias("age"), F.col("c_mktsegment").alias("segment"))
    variables = [Variable("age", "int", 1, target={"Tabella_target": "PERSON", "Voce_tabella_target": "year_of_birth"}), Variable("segment", "str", 2, cardinality=2, levels=("BUILDING", "MACHINERY"), concept_ids=(501, 502), target={"Tabella_target": "PERSON", "Voce_tabella_target": "gender_concept_id", "Voce_tabella_sorgente": "gender_source_value"})]
    return etl.target_rows(c, variables, "PERSON", ["c_custkey"], F.lit("2024-06-01").cast("date"))


@query(
    """WITH h AS (SELECT c_custkey AS file, CASE c_custkey % 3 WHEN 0 THEN 'age' WHEN 1 THEN 'weight' ELSE 'note' END AS variable, CASE c_custkey % 5 WHEN 0 THEN ' years ' WHEN 1 THEN 'kg' WHEN 2 THEN NULL ELSE 'g' END AS unit FROM customer),
e AS (SELECT * FROM (VALUES ('age', 'years'), ('weight', 'kg')) e(variable, expected))
SELECT 'E302' AS code, file, h.variable, unit, expected FROM h JOIN e USING (variable) WHERE trim(coalesce(unit, '')) <> expected"""
)
def dq_header_units(spark, sf):
    """E302: units in the headers of very many files that aren't the protocol's."""
    key = F.col("c_custkey")
    unit = F.when(key % 5 == 0, " years ").when(key % 5 == 1, "kg").when(key % 5 == 2, None).otherwise("g")
    headers = table(spark, sf, "customer").select(key.alias("file"), F.when(key % 3 == 0, "age").when(key % 3 == 1, "weight").otherwise("note").alias("variable"), unit.alias("unit"))
    return quality.header_unit_faults(headers, Protocol((Variable("age", "int", 1, unit="years"), Variable("weight", "float", 2, unit="kg"), Variable("note", "str", 3))), ["file"])


def _results(spark, sf):
    """Check results of orders: a code and variable for each status and priority."""
    o = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    warning = F.col("o_orderstatus") == "O"
    return o.select(F.when(warning, 4).otherwise(5).alias("phase"), F.when(warning, "W401").otherwise("E501").alias("code"), F.when(warning, "warning").otherwise("error").alias("severity"), F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("variable"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("n")).alias("n"), F.lit(True).alias("present"))


@query("SELECT CAST(count(*) AS BIGINT) AS n_warnings FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'")
def dq_total_warnings(spark, sf):
    """The sum of all warnings; absent counts are 0."""
    return quality.total_warnings(_results(spark, sf)).select(F.col("n_warnings").cast("long").alias("n_warnings"))


@query(
    """WITH r AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'W401' ELSE 'E501' END AS code, o_orderstatus || '/' || o_orderpriority AS variable, CASE WHEN o_orderpriority <> '5-LOW' THEN count(*) END AS n FROM orders GROUP BY o_orderstatus, o_orderpriority)
SELECT code, variable, CASE WHEN code = 'W401' THEN -1 ELSE n END AS n FROM r UNION ALL SELECT 'W401', 'new', 7"""
)
def dq_merged_results(spark, sf):
    """Earlier results and new ones: of equal code and variable the new one stays."""
    old = _results(spark, sf)
    fresh = old.where("code = 'W401'").withColumn("n", F.lit(-1).cast("long"))
    more = fresh.limit(1).withColumn("variable", F.lit("new")).withColumn("n", F.lit(7).cast("long"))  # one row of its own
    return quality.merge_results(old, fresh.unionByName(more)).select("code", "variable", "n")


@query(
    """WITH s AS (SELECT vec_id, vec_id // 5 AS series, row_number() OVER (PARTITION BY vec_id // 5 ORDER BY (vec_id * 3) % 5, vec_id) AS place FROM embeddings WHERE vec_id % 4 <> 1)
SELECT CAST(series AS VARCHAR) AS series_id, CAST(place AS INTEGER) AS place, 'L' || vec_id AS label FROM s"""
)
def structure_labels_follow(spark, sf):
    """Labels by the slices' new places, discarded slices being gone."""
    rows = _slices(spark, sf)
    ordered = images.order_slices(rows.where("slice_idx % 4 <> 1").withColumn("z", F.col("slice_idx") * 3 % 5), ["series_id"])
    labels = rows.select("series_id", "slice_idx", F.concat(F.lit("L"), "slice_idx").alias("label"))
    return images.follow_slices(labels, ordered, ["series_id"]).select("series_id", "place", "label")


@query(
    """WITH s AS (SELECT vec_id, list_transform(embedding, lambda v: CASE WHEN v > 0.1 THEN 200 WHEN v > -0.1 THEN 0 ELSE 90 END) AS x FROM embeddings), d AS (SELECT vec_id, x, list_sort(list_distinct(x)) AS v FROM s)
SELECT vec_id, CAST(list_sum(list_transform(x, lambda p: ([0, 3, 8])[list_position(v, p)])) AS BIGINT) AS total, len(v) AS n_values FROM d"""
)
def tensor_value_codes(spark, sf):
    """Values of a mask as the protocol's codes, in their order."""
    x = F.transform("embedding", lambda v: F.when(v > F.lit(0.1), 200).when(v > F.lit(-0.1), 0).otherwise(90))
    rows = table(spark, sf, "embeddings").select("vec_id", x.alias("x"))
    coded = A.mapped(F.col("x"), [8, 0, 3])
    return rows.select("vec_id", F.aggregate(coded, F.lit(0).cast("long"), lambda a, v: a + v).alias("total"), F.size(F.array_distinct("x")).cast("long").alias("n_values"))


@query("SELECT c_custkey % 3 = 0 AS female, count(*) AS n, count(*) AS n_from_list, count(*) AS n_family FROM customer GROUP BY 1")
def etl_synthetic_names(spark, sf):
    """A given name from the list of the person's gender and a family name for every person."""
    persons = table(spark, sf, "customer").select(F.col("c_custkey").alias("person_id"), F.when(F.col("c_custkey") % 3 == 0, 8532).otherwise(8507).alias("gender_concept_id"))
    p, n = table(spark, sf, "part"), table(spark, sf, "nation")
    female, male = (p.where(F.col("p_size") % 2 == k).select(F.concat(F.lit(tag), "p_name", F.lit(" "), "p_partkey").alias("name")) for k, tag in ((0, "f "), (1, "m ")))
    named = etl.synthetic_names(persons, female, male, n.select(F.col("n_name").alias("name")))
    is_female = F.col("gender_concept_id") == 8532
    return named.groupBy(is_female.alias("female")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("given_name").startswith("f ") == is_female).alias("n_from_list"), F.count("family_name").alias("n_family"))


@query(
    """WITH e AS (SELECT list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings), p AS (SELECT CAST(i AS INTEGER) AS i, x[i + 1] AS a, x[(i + 1) % 64 + 1] AS b FROM e, (SELECT unnest(range(64)) AS i))
SELECT i AS "column", round(var_samp(a), 8) AS variance, round(covar_samp(a, b), 8) AS next_covariance FROM p GROUP BY i"""
)
def fed_vector_covariance(spark, sf):
    """The covariance of the vectors' 64 values from a scatter matrix a site, labels being sites: merged by Chan's rule."""
    stats = covariance.pooled(covariance.vector_scatter(table(spark, sf, "embeddings"), "label", "embedding", 64))
    rows = [(i, round(float(stats.covariance[i, i]), 8), round(float(stats.covariance[i, (i + 1) % 64]), 8)) for i in range(64)]
    return spark.createDataFrame(rows, "column int, variance double, next_covariance double")
