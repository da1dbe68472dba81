"""Registry of the site tables: paths, reads and the site-qualified measurement view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresieve.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; any store that Spark's readers open."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def measurements_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements (lineitem) with the site (region name) of their patient.

    The dimension chain region-nation-customer is joined first, so the fact side
    meets one narrow relation per key and Catalyst may broadcast it when its
    measured size allows.
    """
    site = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("site"))
    )
    visits = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(site, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "site")
    )
    facts = table(spark, sf_dir, "lineitem")
    return facts.join(visits, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
