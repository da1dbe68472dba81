"""Replies of sites to a round: the first good one of each, until enough are there and a grace period is over."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from caresieve.session import ship

#: What `gather` and `gather_stream` return.
SCHEMA = "round string, site string, at timestamp, payload string, place int, closed_at timestamp"
#: The state store that timers and maps need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _replies(replies: DataFrame, round_: str, site: str, status: str, at: str, payload: str) -> DataFrame:
    good = replies.where((F.col(status) == "OK") & F.col(round_).isNotNull() & F.col(site).isNotNull() & F.col(at).isNotNull())
    return good.select(F.col(round_).cast("string").alias("round"), F.col(site).cast("string").alias("site"), F.col(at).cast("timestamp").alias("at"), F.col(payload).cast("string").alias("payload"))


def gather(replies: DataFrame, least: int, grace: float, round: str = "round", site: str = "site", status: str = "status", at: str = "at", payload: str = "payload") -> DataFrame:
    """SCHEMA's rows: the replies that each round takes, place counting sites from 1 by arrival.

    A site's reply is its first one with status OK by `at` (of equal times the smallest payload). A
    round closes `grace` seconds after the reply of its `least`-th site; it takes what has
    arrived by then. Rounds of fewer sites give no rows. Replies without a round, site or time count for nothing.
    """
    first = _replies(replies, round, site, status, at, payload).groupBy("round", "site").agg(F.min(F.struct("at", F.col("payload"))).alias("r"))  # sites, not replies, go on
    order = Window.partitionBy("round").orderBy("at", "site")
    placed = first.select("round", "site", "r.at", "r.payload").withColumn("place", F.row_number().over(order))
    enough = F.max(F.when(F.col("place") == least, F.col("at"))).over(Window.partitionBy("round"))
    closed = placed.withColumn("closed_at", (enough + F.make_dt_interval(secs=F.lit(grace))).cast("timestamp"))
    return closed.where(F.col("at") <= F.col("closed_at"))


class _Gather(StatefulProcessor):
    """Keeps each site's first good reply of a round, and a timer for its end."""

    def __init__(self, least: int, grace: float):
        self.least, self.grace = least, grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getMapState("first", "site string", "at timestamp, payload string")
        self.timer = handle.getValueState("timer", "ms bigint")
        self.closed = handle.getValueState("closed", "done boolean")

    def _by_arrival(self) -> list[tuple]:
        return sorted((v[0], k[0], v[1]) for k, v in self.first.iterator())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            if self.closed.exists():
                continue  # all is decided; the iterator is read to its end
            for site, at, payload in zip(frame["site"], frame["at"], frame["payload"]):
                known = self.first.getValue((site,)) if self.first.containsKey((site,)) else None
                new = (at.to_pydatetime(), None if pd.isna(payload) else payload)
                if known is None or (new[0], new[1] is not None, new[1] or "") < (known[0].replace(tzinfo=None), known[1] is not None, known[1] or ""):
                    self.first.updateValue((site,), new)
        if not self.closed.exists():
            sites = self._by_arrival()
            if len(sites) >= self.least:
                end = sites[self.least - 1][0].replace(tzinfo=timezone.utc) + timedelta(seconds=self.grace)
                ms = int(end.timestamp() * 1000) + 1
                if self.timer.exists() and self.timer.get()[0] != ms:
                    self.handle.deleteTimer(self.timer.get()[0])
                self.timer.update((ms,))
                self.handle.registerTimer(ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.closed.exists():
            return
        sites = self._by_arrival()
        end = sites[self.least - 1][0] + timedelta(seconds=self.grace)
        taken = [x for x in sites if x[0] <= end]
        self.closed.update((True,))
        self.first.clear()
        self.timer.clear()
        yield pd.DataFrame({"round": key[0], "site": [x[1] for x in taken], "at": [x[0] for x in taken], "payload": [x[2] for x in taken], "place": range(1, len(taken) + 1), "closed_at": end})

    def close(self) -> None:
        pass


def gather_stream(replies: DataFrame, least: int, grace: float, late: str = "10 seconds", round: str = "round", site: str = "site", status: str = "status", at: str = "at", payload: str = "payload") -> DataFrame:
    """The rows of `gather` over a stream: each round's come once, when the watermark has passed its end.

    Replies may come in any order within `late` of the newest one. State is a row a site of open
    rounds, and a mark for closed ones. Sets the session's state store to the one that timers need.
    """
    spark = ship(replies.sparkSession)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = _replies(replies, round, site, status, at, payload).withWatermark("at", late)
    return rows.groupBy("round").transformWithStateInPandas(statefulProcessor=_Gather(least, grace), outputStructType=SCHEMA, outputMode="Append", timeMode="EventTime")
