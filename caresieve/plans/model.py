"""Load of the common data model, and cohort queries over it."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresieve.functions.text import text_number
from caresieve.operators import cohort, etl
from caresieve.operators.spec import Variable
from caresieve.plans.register import registrar
from caresieve.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}
query = registrar(QUERIES, ORACLE)


@query(
    """WITH e AS (SELECT c_name, c_custkey FROM customer WHERE c_custkey % 3 = 0), i AS (SELECT DISTINCT c_name FROM customer),
f AS (SELECT c_name FROM i WHERE c_name NOT IN (SELECT c_name FROM e))
SELECT i.c_name, e.c_custkey AS person_id, false AS is_new FROM i JOIN e ON i.c_name = e.c_name
UNION ALL SELECT c_name, (SELECT max(c_custkey) FROM e) + row_number() OVER (ORDER BY c_name), true FROM f"""
)
def etl_person_upsert(spark, sf):
    c = table(spark, sf, "customer")
    existing = c.where("c_custkey % 3 = 0").select("c_name", F.col("c_custkey").alias("person_id"))
    return etl.upsert(existing, c, "c_name", "person_id")


@query("SELECT 1000 + row_number() OVER (ORDER BY o_orderkey) AS visit_occurrence_id, o_custkey AS person_id, 32026 AS visit_concept_id, 32817 AS visit_type_concept_id FROM orders")
def etl_visits(spark, sf):
    return etl.visits(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", ["o_orderkey"], 1000)


_FACTS = [etl.Fact(3000, number="l_quantity", unit_concept_id=8529, source_value="quantity"), etl.Fact(3001, number="l_discount", source_value="discount"), etl.Fact(4000, text="l_returnflag", source_value="flag")]


@query(
    """SELECT l_orderkey, l_linenumber, CAST(3000 AS BIGINT) AS concept_id, CASE WHEN l_orderkey % 17 <> 0 THEN l_quantity END AS value_as_number, CAST(NULL AS VARCHAR) AS value_as_string, CAST(8529 AS BIGINT) AS unit_concept_id, 'quantity' AS source_value FROM lineitem WHERE l_orderkey % 17 <> 0
UNION ALL SELECT l_orderkey, l_linenumber, 3001, l_discount, NULL, NULL, 'discount' FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 4000, NULL, l_returnflag, NULL, 'flag' FROM lineitem"""
)
def etl_measurement_eav(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_quantity", F.when(F.col("l_orderkey") % 17 != 0, F.col("l_quantity")))
    return etl.long_facts(rows, ["l_orderkey", "l_linenumber"], _FACTS).drop("value_as_concept_id")


@query("SELECT event_id, CAST(5000 AS BIGINT) AS concept_id, value AS value_as_number, 'value' AS source_value FROM events WHERE value IS NOT NULL UNION ALL SELECT event_id, 5001, NULL, 'type' FROM events WHERE event_type IS NOT NULL")
def etl_observation_eav(spark, sf):
    facts = [etl.Fact(5000, number="value", source_value="value"), etl.Fact(5001, text="event_type", source_value="type")]
    return etl.long_facts(table(spark, sf, "events"), ["event_id"], facts).select("event_id", "concept_id", "value_as_number", "source_value")


_SIZE = Variable("o_orderstatus", cardinality=2, levels=("F", "O"), synonyms={"O": ("P",)}, concept_ids=(8532, 8507))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 8532 WHEN o_orderstatus IN ('O', 'P') THEN 8507 END AS BIGINT) AS concept_id FROM orders")
def etl_concept_map(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", etl.concept_column(_SIZE).alias("concept_id"))


@query("SELECT p_partkey, 2024 - p_size AS year_of_birth FROM part")
def etl_year_of_birth(spark, sf):
    return table(spark, sf, "part").select("p_partkey", etl.year_of_birth(F.col("p_size"), F.lit("2024-06-01").cast("date")).alias("year_of_birth"))


@query(
    """WITH k AS (SELECT DISTINCT p_brand AS label FROM part), t AS (SELECT label, row_number() OVER (ORDER BY label) AS r FROM k), c AS (SELECT label, 210 + r AS concept_id FROM t WHERE r <= 3)
SELECT label, concept_id FROM c UNION ALL SELECT label, (SELECT max(concept_id) FROM c) + row_number() OVER (ORDER BY label) FROM t WHERE r > 3"""
)
def etl_condition_get_or_create(spark, sf):
    part = table(spark, sf, "part")
    first = part.select("p_brand").distinct().orderBy("p_brand").limit(3)
    known = etl.new_ids(first, ["p_brand"], 210, "concept_id").select(F.col("p_brand").alias("concept_name"), "concept_id")
    return etl.conditions(part, "p_brand", known)


@query(
    "SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity AS value, CAST(NULL AS VARCHAR) AS kind FROM lineitem UNION ALL SELECT -event_id, value, event_type FROM events"
)
def etl_observation_view(spark, sf):
    m = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_quantity").alias("value"))
    o = table(spark, sf, "events").select(F.col("event_id").alias("id"), "value", F.col("event_type").alias("kind"))
    return cohort.union_views(m, o)


@query(
    """SELECT 700 + row_number() OVER (ORDER BY o_custkey, l_orderkey, l_linenumber, l_returnflag) AS procedure_occurrence_id, o_custkey AS person_id,
CAST(CASE l_returnflag WHEN 'A' THEN 11 WHEN 'R' THEN 12 ELSE 0 END AS BIGINT) AS procedure_concept_id, l_orderkey AS visit_occurrence_id, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def etl_procedure_rows(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    modalities = {"11": ["A"], "12": ["R"]}
    concepts = {m: etl.procedure_concept(modalities, m) for m in ("A", "R", "N")}
    concept = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in concepts.items() for x in kv]), F.col("l_returnflag")), F.lit(0))
    rows = rows.select("o_custkey", "l_orderkey", "l_linenumber", "l_returnflag")
    return etl.procedures(rows, "o_custkey", "l_orderkey", concept, ["o_custkey", "l_orderkey", "l_linenumber", "l_returnflag"], 700).drop("l_returnflag")


@query("SELECT c_custkey, CAST(CAST('0x' || substr(sha256(c_name), 1, 16) AS UBIGINT) % 10000000000 AS BIGINT) AS number FROM customer")
def etl_text_number(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text_number(F.col("c_name")).alias("number"))


@query("SELECT c_name, CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS id FROM customer")
def etl_append_absent(spark, sf):
    """Known customers keep the ids that they have, which aren't those of the incoming rows."""
    c = table(spark, sf, "customer").select("c_name", F.col("c_custkey").alias("id"))
    return etl.append_absent(c.where("id % 3 = 0").withColumn("id", -F.col("id")), c.unionByName(c), ["c_name"])


@query(
    "SELECT r_name, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY r_name"
)
def cohort_five_way_join(spark, sf):
    t = lambda n: table(spark, sf, n)
    persons = cohort.label_filter(t("customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])
    sites = persons.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    rows = t("orders").join(sites, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r_name").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def cohort_label_filter(spark, sf):
    return cohort.label_filter(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("SELECT l_orderkey, count(*) AS n_series, string_agg(l_linenumber || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS series FROM lineitem GROUP BY l_orderkey")
def cohort_series_nested(spark, sf):
    nested = cohort.nested_series(table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_returnflag"], ["l_linenumber"])
    return nested.select("l_orderkey", F.size("series").cast("long").alias("n_series"), F.array_join(F.transform("series", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_returnflag"])), ",").alias("series"))


@query("SELECT l_orderkey, count(*) AS n_series FROM lineitem WHERE contains(l_returnflag, 'R') GROUP BY l_orderkey")
def cohort_series_select(spark, sf):
    nested = cohort.nested_series(table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_returnflag"], ["l_linenumber"])
    return cohort.select_series(nested, "l_returnflag", "R").select("l_orderkey", F.size("series").cast("long").alias("n_series"))


_TYPES = ("click", "view", "purchase", "signup", "logout")


@query("SELECT user_id, " + ", ".join(f"round(min_by(value, event_id) FILTER (WHERE event_type = '{t}'), 6) AS \"{t}\"" for t in _TYPES) + " FROM events GROUP BY user_id")
def cohort_pivot_first(spark, sf):
    out = cohort.pivot_first(table(spark, sf, "events"), "user_id", "event_type", "value", "event_id", list(_TYPES))
    return out.select("user_id", *[F.round(t, 6).alias(t) for t in _TYPES])


@query("SELECT event_id, k AS feature, CAST(json_extract_string(props, '$.\"' || k || '\"') AS DOUBLE) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def json_feature_explode(spark, sf):
    return cohort.explode_features(table(spark, sf, "events"), "props", "event_id")
