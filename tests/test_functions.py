import datetime

import pytest
from pyspark.sql import functions as F

from caresieve.functions import arrays as A
from caresieve.functions import text
from caresieve.functions.dates import malformed, spark_pattern
from caresieve.functions.distributions import f_cdf, f_quantile
from caresieve.functions.predicates import SpecError, days_between, formula, holds, parse, violates_any


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("bad", ["", "1", ">", ">=x", "__import__('os')", ">= 1; 2", "=> 3"])
def test_predicates_are_a_closed_grammar(bad):
    with pytest.raises(SpecError):
        parse(bad)


def test_predicates(spark):
    assert parse("< 80 %") == ("<", 80.0)
    assert holds(">=-1.5", -1.5) and not holds("!=2", 2)
    assert one(spark, violates_any([">=0", "<=120"], F.lit(130.0)))
    assert not one(spark, violates_any([">=0", "<=120"], F.lit(None).cast("double")))


def test_formula(spark):
    assert one(spark, formula("a + b", {"a": F.lit(2), "b": F.lit(3)})) == 5
    with pytest.raises(SpecError):
        formula("a.b - c", {})
    days = days_between("var2 - var1", {"var1": F.lit(datetime.date(2024, 2, 1)), "var2": F.lit(datetime.date(2024, 2, 11))})
    assert one(spark, days) == 10


def test_dates_follow_strptime(spark):
    assert spark_pattern("%d/%m/%Y") == "d/M/yyyy"
    rows = spark.createDataFrame([("01/02/2024",), ("1/2/2024",), ("31/02/2024",), ("1/2/24",), (None,), ("-999",), ("x",)], "d string")
    got = [r[0] for r in rows.select(malformed(F.col("d"), "%d/%m/%Y", "-999")).collect()]
    assert got == [False, False, True, True, False, False, True]


def test_f_distribution():
    assert f_quantile(0.95, 2, 10) == pytest.approx(4.1028, abs=1e-4)
    assert f_quantile(0.95, 5, 20) == pytest.approx(2.7109, abs=1e-4)
    assert f_cdf(f_quantile(0.3, 7, 3), 7, 3) == pytest.approx(0.3, abs=1e-9)


def test_text(spark):
    import hashlib

    assert one(spark, text.text_number(F.lit("abc"))) == int(hashlib.sha256(b"abc").hexdigest()[:16], 16) % 10**10
    assert one(spark, text.normal_path(F.lit("a\\b//c/"))) == "a/b/c"
    assert one(spark, text.without_visit(F.lit("patient00001_ABCDE_3"))) == "patient00001_ABCDE"
    assert one(spark, text.decimal_points(F.lit("1,5;2,25"))) == "1.5;2.25"
    assert one(spark, text.lower_extension(F.lit("A/b.DCM"))) == "A/b.dcm"
    assert one(spark, text.numeric_order(F.lit("none"))) is None


def test_arrays(spark):
    import numpy as np

    x = [3.0, -1.0, 4.0, 1.5, 9.0]
    c = F.array(*[F.lit(v) for v in x])
    assert one(spark, A.percentile(c, 0.3)) == pytest.approx(np.percentile(x, 30))
    assert one(spark, A.standardised(c)) == pytest.approx(((np.array(x) - np.mean(x)) / np.std(x)).tolist())
    assert one(spark, A.min_max(c, -1, 1))[4] == 1.0
    assert one(spark, A.min_max(F.array(F.lit(2.0), F.lit(2.0)))) is None
    assert one(spark, A.correlation(c, A.inverted(c))) == pytest.approx(-1)
    assert one(spark, A.mapped(F.array(F.lit(255), F.lit(0), F.lit(127)), [2, 0, 1])) == [2, 0, 1]
