"""What a Spark session needs so that Python workers can run this package's functions."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> SparkSession:
    """Puts the package's folder on the path of Python workers, also if it isn't installed there.

    On a cluster whose nodes don't have the folder, add the package with --py-files.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    return spark
