"""Checkpoints in the shared folder, and joins on keys of which a few hold very many rows."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys with over max(HOT_ROWS, all / HOT_KEYS) rows are salted, so there are at most HOT_KEYS of them.
HOT_ROWS = 4096
HOT_KEYS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder: the session's spark.checkpoint.dir.

    Only a session in one process (tests) may have none and gets one of its own; on a
    cluster, whose executors don't share local folders, that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="caresieve-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder, without its lineage.

    The files are removed when the plan that reads them is no longer held by anything
    and has been collected.
    """
    spark = df.sparkSession
    spark.sparkContext._conf.set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # asked for at each checkpoint, so in force from now on
    shared_folder(spark)
    return df.checkpoint(eager=True)


class Steps:
    """Tables of a loop, written to the shared folder and read again.

    A checkpoint keeps the optimizer's guess of its size, which joins multiply: in a
    loop it gets digits without end. A table that is read has its own size.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.held = spark, f"{shared_folder(spark)}/steps-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.held += 1
        path = f"{self.root}/{self.held}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, before: int | None = None) -> None:
        """Removes the tables before this one (counting from 1), or all."""
        sc = self.spark.sparkContext
        paths = [self.root] if before is None else [f"{self.root}/{i}" for i in range(1, before)]
        for path in paths:
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def salted_join(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, salt_by: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of rows to facts, which holds one row a key and, in `count`, how many rows have it.

    The list of hot keys is bounded by HOT_KEYS, so it may be broadcast: keys must be
    of bounded size (hashes, numbers, ids). A hot key of n rows is dealt over
    n / limit tasks by the hash of `salt_by`, and its fact is copied to each; other
    keys are joined as they are. Null keys meet nothing. facts is read three times:
    materialise it first.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    limit = max(hot_rows, total // HOT_KEYS)
    salts, salt = free_names([*rows.columns, *facts.columns], "salts", "salt")
    shares = F.ceil(F.col(count) / limit).cast("int")
    hot = facts.where(F.col(count) > limit).select(*keys, shares.alias(salts))
    left = rows.join(F.broadcast(hot), keys, "left")
    left = left.withColumn(salt, F.coalesce(F.pmod(F.xxhash64(F.col(salt_by)), F.col(salts)).cast("int"), F.lit(0))).drop(salts)
    fan = F.when(F.col(count) > limit, F.sequence(F.lit(0), shares - 1)).otherwise(F.array(F.lit(0)))
    return left.join(facts.withColumn(salt, F.explode(fan)), [*keys, salt], "inner").drop(salt)


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names like the wanted ones that none of the taken ones clashes with, in any case of letters."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
