"""Gathering of replies with a quorum and a grace period: batch against a plain loop, stream against batch."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from caresieve.streaming import gather

START = datetime(2024, 1, 1)
SCHEMA = "round string, site string, status string, at timestamp, payload string"


def replies():
    rng = random.Random(4)
    rows = []
    for r in range(6):
        for s in range(8):
            for k in range(rng.randrange(0, 4)):
                rows.append((f"r{r}", f"s{s}", rng.choice(["OK", "OK", "ERROR"]), START + timedelta(seconds=100 * r + rng.randrange(0, 30)), f"p{k}"))
    rows += [("few", "s1", "OK", START, "p"), ("few", "s1", "OK", START, "q"), (None, "s1", "OK", START, "p"), ("r1", None, "OK", START, "p"), ("r1", "s9", "OK", None, "p")]
    return rows


def plain(rows, least, grace):
    out = []
    for r in {x[0] for x in rows if x[0]}:
        first = {}
        for _, site, status, at, payload in (x for x in rows if x[0] == r):
            if status == "OK" and site and at:
                first[site] = min(first.get(site, (at, payload)), (at, payload))
        order = sorted((at, site, payload) for site, (at, payload) in first.items())
        if len(order) >= least:
            end = order[least - 1][0] + timedelta(seconds=grace)
            out += [(r, site, at, payload, i + 1, end) for i, (at, site, payload) in enumerate(order) if at <= end]
    return sorted(out)


def test_batch(spark):
    df = spark.createDataFrame(replies(), SCHEMA).repartition(4)
    for least, grace in ((1, 0), (3, 5), (4, 2.5), (9, 1)):
        assert sorted(tuple(x) for x in gather.gather(df, least, grace).collect()) == plain(replies(), least, grace)
    assert gather.gather(df.where("false"), 1, 1).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = [x for x in replies() if x[3]]
    rng = random.Random(1)
    rows.sort(key=lambda x: x[3] + timedelta(seconds=rng.uniform(0, 8)))  # out of order, within what is late
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for i in range(0, len(rows), 12):
        spark.createDataFrame(rows[i : i + 12], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.createDataFrame([("last", "s1", "OK", START + timedelta(days=1), "p")], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    try:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 3).parquet(f"{tmp_path}/in")
        out = gather.gather_stream(stream, 3, 5, "20 seconds")
        query = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        got = spark.read.parquet(f"{tmp_path}/out")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    assert sorted(tuple(x) for x in got.where(F.col("round") != "last").collect()) == plain(rows, 3, 5)
