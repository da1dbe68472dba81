"""Preparation over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresieve.operators import prepare as p
from caresieve.operators.spec import Protocol, Transformation, Variable
from caresieve.plans.register import registrar
from caresieve.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}
query = registrar(QUERIES, ORACLE)

_LETTERS = " || ".join(f"chr(CAST(65 + CAST('0x' || substr(sha256('pseudonym:' || c_custkey), {1 + 2 * i}, 2) AS INTEGER) % 26 AS INTEGER))" for i in range(5))
_NUMBER = "CAST(row_number() OVER (ORDER BY c_custkey) AS VARCHAR)"
_NAMES = f"SELECT c_custkey, 'patient' || lpad({_NUMBER}, CAST(greatest(5, length({_NUMBER})) AS INTEGER), '0') || '_' || {_LETTERS} AS new_id FROM customer"


def _names(spark, sf):
    return p.pseudonym_map(table(spark, sf, "customer").select("c_custkey"), "c_custkey")


@query(_NAMES)
def prep_pseudonym_map(spark, sf):
    return _names(spark, sf)


@query(f"WITH n AS ({_NAMES}) SELECT o_orderkey, new_id || '_' || row_number() OVER (PARTITION BY new_id ORDER BY o_orderkey) AS o_custkey FROM orders JOIN n ON o_custkey = c_custkey")
def prep_pseudonymise(spark, sf):
    names = _names(spark, sf).withColumnRenamed("c_custkey", "o_custkey")
    return p.pseudonymise(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", names, ["o_orderkey"])


_VISITS = Protocol(
    (Variable("ordered", date_format="%d/%m/%Y"), Variable("shipped", date_format="%d/%m/%Y")),
    missing=-999,
    transformations=(Transformation("days", "var2 - var1", "days", {"var1": "ordered", "var2": "shipped"}),),
)


@query(
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 19 = 0 THEN -999 ELSE CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) END AS days FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
)
def prep_date_diff(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.date_format("o_orderdate", "d/M/yyyy").alias("ordered"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 19 == 0, "31/02/2024").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("shipped")).join(o, "l_orderkey")
    return p.derive(rows, _VISITS).select("l_orderkey", "l_linenumber", "days")


def _gaps(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 17 == 0, -999.0).otherwise(F.col("l_quantity")).alias("v"))


@query("WITH m AS (SELECT avg(l_quantity) AS m FROM lineitem WHERE l_orderkey % 17 <> 0) SELECT l_orderkey, l_linenumber, round(CASE WHEN l_orderkey % 17 = 0 THEN m ELSE l_quantity END, 6) AS v FROM lineitem, m")
def prep_mean_impute(spark, sf):
    return p.impute_mean(_gaps(spark, sf), ["v"], -999.0).withColumn("v", F.round("v", 6))


@query("WITH m AS (SELECT avg(l_quantity) AS m FROM lineitem WHERE l_orderkey % 17 <> 0) SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 17 = 0 THEN trunc(m) + (CASE WHEN m - trunc(m) >= 0.5 THEN 1 ELSE 0 END) ELSE l_quantity END AS v FROM lineitem, m")
def prep_mean_impute_int(spark, sf):
    return p.impute_mean(_gaps(spark, sf), ["v"], -999)


@query(
    """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 26 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders),
l AS (SELECT DISTINCT status AS s FROM b WHERE status IS NOT NULL)
SELECT o_orderkey, status, priority FROM b WHERE status IS NOT NULL AND priority IS NOT NULL
UNION ALL SELECT o_orderkey, s, priority FROM b, l WHERE status IS NULL AND priority IS NOT NULL"""
)
def prep_categorical_expand(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(k, F.when(k % 13 != 0, F.col("o_orderstatus")).alias("status"), F.when(k % 26 != 0, F.col("o_orderpriority")).alias("priority"))
    return p.expand_categories(rows, ["status", "priority"])


_STATUS = Variable("o_orderstatus", cardinality=3, levels=("F", "O", "P"), order=0)
_PRIORITY = Variable("o_orderpriority", cardinality=5, levels=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), order=1, coding={"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "5-LOW": 4})


@query("SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderstatus = '{x}' THEN 1 ELSE 0 END AS o_orderstatus_{x}" for x in "FOP") + ", o_custkey FROM orders")
def prep_one_hot(spark, sf):
    return p.encode(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"), [_STATUS])


@query("SELECT o_orderkey, CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _PRIORITY.coding.items()) + " END AS o_orderpriority FROM orders")
def prep_ordinal_encode(spark, sf):
    return p.encode(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), [_PRIORITY])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 13 <> 0")
def prep_gt_filter(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 13 == 0, "-999").otherwise(F.col("o_orderstatus")).alias("truth"))
    return p.drop_missing_truth(rows, "truth", -999).drop("truth")


@query("SELECT o_orderkey, o_custkey AS key, c_name, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 <> 0")
def prep_merge_many_to_one(spark, sf):
    right = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("key"), "c_name", "c_acctbal")
    return p.merge_many_to_one(table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("key")), right, "key")


_SPLIT = "SELECT {cols}, CASE WHEN row_number() OVER ({part} ORDER BY md5('42:' || {key}), {key}) <= floor(count(*) OVER ({part}) * 0.2) THEN 'test' ELSE 'train' END AS split FROM {table}"


@query(_SPLIT.format(cols="doc_id, toxic", part="PARTITION BY toxic", key="doc_id", table="labels"))
def prep_stratified_split(spark, sf):
    return p.split(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", 42, 0.2, "toxic")


@query(_SPLIT.format(cols="c_custkey", part="", key="c_custkey", table="customer"))
def prep_simple_split(spark, sf):
    return p.split(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 42, 0.2)


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS label FROM orders WHERE o_orderstatus IN ('F', 'O')")
def prep_map_labels(spark, sf):
    return p.map_labels(table(spark, sf, "orders"), "o_orderstatus", {"F": 0, "O": 1}).select("o_orderkey", "label")


@query("SELECT * FROM (VALUES ('status', 'V001', 'F', 'V001.01'), ('status', 'V001', 'O', 'V001.02'), ('age', 'V002', NULL, NULL)) t(variable, variable_code, level, level_code)")
def prep_code_map(spark, sf):
    return p.code_map(Protocol((Variable("age", "int", 2), Variable("status", position=1, cardinality=2, levels=("F", "O")))), spark)
