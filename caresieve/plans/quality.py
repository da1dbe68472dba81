"""Quality checks over the driver tables, with dirt derived from the keys in the same way as in the oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresieve.operators import quality as q
from caresieve.operators import schema
from caresieve.operators.spec import Protocol, Variable, position_faults
from caresieve.plans.register import registrar
from caresieve.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}
query = registrar(QUERIES, ORACLE)

PROTOCOL = Protocol(
    (
        Variable("l_quantity", "int", 1, ranges=(">=2", "<=45")),
        Variable("l_discount", "float", 2, ranges=("<0.08",)),
        Variable("l_returnflag", "str", 3, cardinality=3, levels=("A", "N", "R")),
        Variable("ship", "str", 4, date_format="%d/%m/%Y"),
    ),
    missing=-999,
    other_missing=("NA", "?"),
)
DIRTY_SQL = """SELECT l_orderkey, l_linenumber,
CASE WHEN l_orderkey % 17 = 0 THEN '-999' WHEN l_orderkey % 23 = 0 THEN 'NA' WHEN l_orderkey % 29 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS l_quantity,
CASE WHEN l_partkey % 31 = 0 THEN 'x' ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS l_discount,
CASE WHEN l_suppkey % 13 = 0 THEN '?' ELSE l_returnflag END AS l_returnflag,
CASE WHEN l_orderkey % 19 = 0 THEN '31/02/2024' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS ship FROM lineitem"""


def dirty(spark, sf):
    """Measurements as texts, with sentinels, tokens, bad numbers and bad dates at fixed keys."""
    k = F.col("l_orderkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(k % 17 == 0, "-999").when(k % 23 == 0, "NA").when(k % 29 == 0, None).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("l_quantity"),
        F.when(F.col("l_partkey") % 31 == 0, "x").otherwise(F.col("l_discount").cast("decimal(4,2)").cast("string")).alias("l_discount"),
        F.when(F.col("l_suppkey") % 13 == 0, "?").otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        F.when(k % 19 == 0, "31/02/2024").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("ship"),
    )


_COLUMNS = ("l_quantity", "l_discount", "l_returnflag", "ship")


def _checks(code: str):
    return [c for c in q.row_checks(PROTOCOL, list(_COLUMNS)) if c.code == code]


_MISSING = "({c} IS NULL OR {c} IN ('NaN', 'NA', '?'))"
_NUMBER = "TRY_CAST({c} AS DOUBLE)"
_OUT = {"l_quantity": "({v} < 2 OR {v} > 45) AND l_quantity <> '-999'", "l_discount": "{v} >= 0.08"}
_BAD_TYPE = {"l_quantity": r"l_quantity <> '-999' AND NOT regexp_full_match(l_quantity, '-?\d+')", "l_discount": r"NOT regexp_full_match(l_discount, '-?\d+(\.\d+)?')"}
_BAD_DATE = "try_strptime(ship, '%d/%m/%Y') IS NULL AND ship IS NOT NULL"


@query(f"WITH d AS ({DIRTY_SQL}) " + " UNION ALL ".join(f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {_MISSING.format(c=c)}) AS n FROM d" for c in _COLUMNS))
def dq_missing_tokens(spark, sf):
    return q.run_checks(dirty(spark, sf), _checks("E201")).select("variable", "n")


@query(f"WITH d AS ({DIRTY_SQL}) " + " UNION ALL ".join(f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {t.format(v=_NUMBER.format(c=c))}) AS n FROM d" for c, t in _OUT.items()))
def dq_range_violations(spark, sf):
    return q.run_checks(dirty(spark, sf), _checks("E401")).select("variable", "n")


@query(f"WITH d AS ({DIRTY_SQL}) " + " UNION ALL ".join(f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {t}) > 0 AS present FROM d" for c, t in _BAD_TYPE.items()))
def dq_type_conformance(spark, sf):
    return q.run_checks(dirty(spark, sf), _checks("E304")).select("variable", "present")


@query(f"WITH d AS ({DIRTY_SQL}) SELECT 'ship' AS variable, CAST(l_orderkey AS VARCHAR) AS key, ship AS value FROM d WHERE {_BAD_DATE}")
def dq_date_format(spark, sf):
    return q.locate(dirty(spark, sf), _checks("E601"), "l_orderkey").select("variable", "key", "value")


@query(
    "WITH s AS (SELECT CASE WHEN l_orderkey % 17 = 0 THEN -999 ELSE l_quantity END AS v, l_extendedprice AS w FROM lineitem) "
    "SELECT 'l_quantity' AS variable, round(100 * stddev_pop(v) FILTER (WHERE v <> -999) / avg(v) FILTER (WHERE v <> -999), 6) AS cv, round(100 * stddev_pop(v) / avg(v), 6) AS cv_all, "
    "round(100 * stddev_samp(v) FILTER (WHERE v <> -999) / avg(v) FILTER (WHERE v <> -999), 6) AS cv_sample FROM s "
    "UNION ALL SELECT 'l_extendedprice', round(100 * stddev_pop(w) / avg(w), 6), round(100 * stddev_pop(w) / avg(w), 6), round(100 * stddev_samp(w) / avg(w), 6) FROM s"
)
def dq_variability_cv(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 17 == 0, -999.0).otherwise(F.col("l_quantity")).alias("l_quantity"), "l_extendedprice")
    names = ["l_quantity", "l_extendedprice"]
    parts = [q.variability(rows, names, -999), q.variability(rows, names, -999, include_sentinel=True).withColumnRenamed("cv", "cv_all"), q.variability(rows, names, -999, sample=True).withColumnRenamed("cv", "cv_sample")]
    out = parts[0].join(parts[1], "variable").join(parts[2], "variable")
    return out.select("variable", *[F.round(c, 6).alias(c) for c in ("cv", "cv_all", "cv_sample")])


_STATUS = Variable("o_orderstatus", "str", 1, cardinality=3, levels=("F", "O", "X"), ground_truth=False)


@query("SELECT 'o_orderstatus' AS variable, o_orderstatus AS level, 'extra' AS problem FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'X') GROUP BY 2 UNION ALL SELECT 'o_orderstatus', l, 'missing' FROM (VALUES ('F'), ('O'), ('X')) t(l) WHERE l NOT IN (SELECT o_orderstatus FROM orders)")
def dq_level_conformance(spark, sf):
    return q.level_conformance(table(spark, sf, "orders"), _STATUS).select("variable", "level", "problem")


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_SEGMENT = Variable("segment", "str", 1, cardinality=5, levels=_SEGMENTS, synonyms={s: (s.lower(),) for s in _SEGMENTS})


@query("SELECT CASE WHEN c_custkey % 31 = 0 AND c_custkey % 7 <> 0 THEN 'OTHER' ELSE c_mktsegment END AS segment, count(*) AS n FROM customer GROUP BY 1")
def dq_synonym_canonical(spark, sf):
    c = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 7 == 0, F.lower("c_mktsegment")).when(F.col("c_custkey") % 31 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("segment"))
    return c.select(q.canonical(F.col("segment"), _SEGMENT).alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


_REPEATED = "SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem UNION ALL SELECT -(l_orderkey * 10 + l_linenumber), l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem WHERE l_orderkey % 11 = 0"


def _repeated(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_orderkey")
    return rows.unionByName(rows.where("l_orderkey % 11 = 0").withColumn("id", -F.col("id"))).drop("l_orderkey")


@query(f"SELECT count(*) AS n_rows, count(*) - count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS n_replicates FROM ({_REPEATED})")
def dq_replicates(spark, sf):
    r = q.number_replicates(_repeated(spark, sf), "id", ["id"])
    return r.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("copy") > 1).alias("n_replicates"))


@query(f"SELECT min(id) AS id, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM ({_REPEATED}) GROUP BY ALL")
def dq_replicates_keep_first(spark, sf):
    return q.keep_first(_repeated(spark, sf), "id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)")
def dq_unmapped_ids(spark, sf):
    known = table(spark, sf, "customer").where("c_custkey % 5 <> 0")
    return q.unmapped(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), known, "o_custkey", "c_custkey")


@query(
    "WITH p AS (SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN '1' ELSE '0' END || CASE WHEN EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey) THEN '1' ELSE '0' END || CASE WHEN c_acctbal > 0 THEN '1' ELSE '0' END AS pattern FROM customer) SELECT pattern, count(*) AS n FROM p WHERE contains(pattern, '0') GROUP BY pattern"
)
def dq_modality_patterns(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") > 0).cast("int").alias("genomic"))
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("clinical", F.lit(1))
    b = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey")).distinct().withColumn("image", F.lit(1))
    return q.modality_patterns(c.join(a, "c_custkey", "left").join(b, "c_custkey", "left"), "c_custkey", ["clinical", "image", "genomic"])


@query(
    "WITH o AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS level FROM orders) SELECT level, count(*) AS n, round((1 - count(*) / (SELECT count(*) FROM o) * 3) * 100, 6) AS gap, (1 - count(*) / (SELECT count(*) FROM o) * 3) * 100 >= 30 AS flagged FROM o WHERE level IS NOT NULL GROUP BY level"
)
def dq_level_imbalance(spark, sf):
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus")).alias("level"))
    return q.imbalance(o, "level", 3, "<30%").withColumn("gap", F.round("gap", 6))


@query(
    """WITH n AS (SELECT n_name, CASE WHEN n_nationkey % 6 <> 0 THEN n_nationkey END AS p FROM nation), t AS (SELECT max(p) AS top FROM n)
SELECT 'no variable has position ' || p AS fault FROM (SELECT unnest(range(1, (SELECT top FROM t) + 1)) AS p) WHERE p NOT IN (SELECT p FROM n WHERE p IS NOT NULL)
UNION ALL SELECT (SELECT count(*) FROM nation WHERE n_regionkey = 0) || ' variables are the ground truth; one must be'"""
)
def dq_protocol_positions(spark, sf):
    """The nations as a protocol's variables, every sixth without a position, Africa's as ground truths."""
    nation = table(spark, sf, "nation")
    return position_faults(nation.select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 6 != 0, F.col("n_nationkey")).alias("position"), (F.col("n_regionkey") == 0).alias("ground_truth")))


def _summary_sql() -> str:
    cell = "SELECT {p} AS phase, '{c}' AS code, 'error' AS severity, {n} AS n FROM d"
    parts = [cell.format(p=2, c="E201", n=" + ".join(f"count(*) FILTER (WHERE {_MISSING.format(c=c)})" for c in _COLUMNS))]
    parts.append(cell.format(p=3, c="E304", n=" + ".join(f"least(count(*) FILTER (WHERE {t}), 1)" for t in _BAD_TYPE.values())))
    parts.append(cell.format(p=4, c="E401", n=" + ".join(f"count(*) FILTER (WHERE {t.format(v=_NUMBER.format(c=c))})" for c, t in _OUT.items())))
    parts.append(cell.format(p=6, c="E601", n=f"least(count(*) FILTER (WHERE {_BAD_DATE}), 1)"))
    return f"WITH d AS ({DIRTY_SQL}) SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n > 0"


@query(_summary_sql())
def dq_summary_fused(spark, sf):
    found = q.run_checks(dirty(spark, sf), q.row_checks(PROTOCOL, list(_COLUMNS)))
    return q.summarise(found).select("phase", "code", "severity", F.col("n").cast("long").alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 41 <> 0 WHERE c_custkey IS NULL")
def dq_reference_faults(spark, sf):
    target = table(spark, sf, "customer").where("c_custkey % 41 <> 0")
    return schema.reference_faults(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", target, "c_custkey")


@query("SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def dq_key_faults(spark, sf):
    return schema.key_faults(table(spark, sf, "lineitem"), "l_orderkey").withColumnRenamed("l_orderkey", "key")


@query(f"WITH d AS ({DIRTY_SQL}) " + " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS level, count(*) AS n FROM d WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("l_returnflag", "l_discount")))
def dq_level_frequencies(spark, sf):
    return q.level_frequencies(dirty(spark, sf), ["l_returnflag", "l_discount"])


def _validate_sql() -> str:
    row = "SELECT {p} AS phase, '{c}' AS code, '{s}' AS severity, {v} AS variable, CAST({n} AS BIGINT) AS n FROM d"
    parts = [row.format(p=2, c="E201", s="error", v=f"'{c}'", n=f"count(*) FILTER (WHERE {_MISSING.format(c=c)})") for c in _COLUMNS]
    parts += [row.format(p=3, c="E304", s="error", v=f"'{c}'", n=f"least(count(*) FILTER (WHERE {t}), 1)") for c, t in _BAD_TYPE.items()]
    parts += [row.format(p=4, c="E401", s="error", v=f"'{c}'", n=f"count(*) FILTER (WHERE {t.format(v=_NUMBER.format(c=c))})") for c, t in _OUT.items()]
    parts.append(row.format(p=6, c="E601", s="error", v="'ship'", n=f"least(count(*) FILTER (WHERE {_BAD_DATE}), 1)"))
    parts.append(row.format(p=5, c="E501", s="error", v="'l_returnflag'", n="least(count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')), 1)") + " HAVING count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) > 0")
    parts.append(row.format(p=7, c="W701", s="warning", v="NULL", n=f"count(*) - count(DISTINCT ({', '.join(_COLUMNS)}))"))
    parts += [f"SELECT 3, '{c}', 'error', NULL, 0" for c in ("E301", "E303")]
    return f"WITH d AS ({DIRTY_SQL}) SELECT *, n > 0 AS present FROM ({' UNION ALL '.join(parts)})"


@query(_validate_sql())
def dq_validate_table(spark, sf):
    d = dirty(spark, sf).withColumn("l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber")).drop("l_linenumber")
    return q.validate(d, PROTOCOL, "l_orderkey")


@query(f"SELECT * FROM ({_validate_sql()}) WHERE phase <= 2")
def dq_validate_failfast(spark, sf):
    """Missing values are errors of phase 2, so later phases aren't read."""
    d = dirty(spark, sf).withColumn("l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber")).drop("l_linenumber")
    return q.validate(d, PROTOCOL, "l_orderkey", "failfast")
