"""Checks over arriving rows: windowed counts with late data, one fused pass per batch, resumable phases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresieve.operators.quality import Check, run_checks


def stream_table(spark: SparkSession, path: str, schema, per_trigger: int = 1) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def windowed_counts(events: DataFrame, at: str, by: str, value: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, by, n, total) per tumbling window; the same plan for a batch and a stream.

    A stream drops rows later than `late` and keeps state for that long.
    """
    rows = events.withWatermark(at, late) if events.isStreaming else events
    out = rows.groupBy(F.window(at, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, at: str, by: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(by, session_start, session_end, n) of runs of events with no longer gap."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    out = rows.groupBy(by, F.session_window(at, gap).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def check_stream(stream: DataFrame, checks: list[Check], sink: str, checkpoint: str) -> object:
    """Every arriving batch through the fused checks; results land in sink/batch=N, so a replayed batch overwrites itself."""

    def each(batch: DataFrame, number: int) -> None:
        run_checks(batch, checks).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def quorum(replies: DataFrame, site: str, ok: str, least: int) -> DataFrame:
    """One good reply of each site; fails when read if there are fewer than `least` sites.

    Of several replies the one whose columns hash lowest is taken, on every run the same;
    for replies with a time use streaming.gather.
    """
    columns = F.struct(*[F.col(f"`{c}`") for c in replies.columns])
    good = replies.where(F.col(ok) == "OK").groupBy(F.col(site).alias("__site")).agg(F.min_by(columns, F.xxhash64(columns)).alias("r")).select("r.*")
    n = good.agg(F.count(F.lit(1)).alias("__n"))
    enough = F.when(F.col("__n") < least, F.raise_error(F.lit(f"fewer than {least} sites replied")).cast("long")).otherwise(F.col("__n"))
    return good.crossJoin(F.broadcast(n)).where(enough >= least).drop("__n")


def run_phases(spark: SparkSession, state: str, phases: list[tuple[str, Callable[[], DataFrame]]]) -> list[str]:
    """Runs the phases that `state` doesn't hold yet, each written to state/name; returns those that ran.

    A phase counts as done when its _SUCCESS is there, so a run that broke off goes on
    where it stopped.
    """
    ran = []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, make in phases:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/{name}/_SUCCESS")
        if path.getFileSystem(conf).exists(path):
            continue
        make().write.mode("overwrite").parquet(f"{state}/{name}")
        ran.append(name)
    return ran
