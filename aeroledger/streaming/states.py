"""Newest report per station as stream state that ends by itself.

A station's state is its newest report. A timer on event time, set a day behind the report, ends it: the station then
has no report until a new one comes. So the state holds one small row for each station that was heard of within a day,
however long the stream runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship_package

# State with timers is kept in this store.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
LIFETIME = dt.timedelta(hours=24)
EMITTED = "station_id string, metar_id long, micros long, change string"
CHANGES = "station_id string, metar_id long, observation_time timestamp, change string"


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Within it streams of the session keep their state in the store that has timers."""
    name, store = PROVIDER
    before = spark.conf.get(name)
    spark.conf.set(name, store)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class NewestReport(StatefulProcessor):
    """Emits a row when a station's newest report changes, and one when it has ended."""

    def __init__(self, lifetime: dt.timedelta = LIFETIME):
        self.lifetime_ms = int(lifetime.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "metar_id long, micros long")

    def _row(self, station: str, held: tuple, change: str) -> pd.DataFrame:
        return pd.DataFrame({"station_id": [station], "metar_id": [held[0]], "micros": [held[1]], "change": [change]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.get() if self.newest.exists() else None
        best = None if held is None else (held[1], held[0])
        for part in rows:
            for micros, number in zip(part["micros"], part["metar_id"]):
                best = max(best, (int(micros), int(number))) if best else (int(micros), int(number))
        if held is None or best != (held[1], held[0]):
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.newest.update((best[1], best[0]))
            self.handle.registerTimer(best[0] // 1000 + self.lifetime_ms)
            yield self._row(key[0], (best[1], best[0]), "newest")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            held = self.newest.get()
            self.newest.clear()
            yield self._row(key[0], held, "ended")

    def close(self) -> None:
        pass


def newest_with_timers(stream: DataFrame, delay: str = "0 seconds", lifetime: dt.timedelta = LIFETIME) -> DataFrame:
    """Changes of each station's newest report; ``stream`` has ``station_id, metar_id, observation_time``.

    Reports that come more than ``delay`` behind the newest of all are dropped.
    """
    ship_package(stream.sparkSession)
    timed = stream.select("station_id", "metar_id", F.col("observation_time").cast("timestamp").alias("observation_time"))
    timed = timed.withWatermark("observation_time", delay).withColumn("micros", F.unix_micros("observation_time"))
    changes = timed.groupBy("station_id").transformWithStateInPandas(
        statefulProcessor=NewestReport(lifetime), outputStructType=EMITTED, outputMode="append", timeMode="EventTime"
    )
    return changes.select("station_id", "metar_id", F.timestamp_micros("micros").alias("observation_time"), "change")


def current(changes: DataFrame) -> DataFrame:
    """Per station its last change: the newest report, or that it has ended."""
    last = changes.groupBy("station_id").agg(
        F.max_by(F.struct("metar_id", "change"), F.struct("observation_time", "metar_id", F.col("change") == "ended")).alias("last"),
        F.max("observation_time").cast("timestamp_ntz").alias("observation_time"),
    )
    return last.select("station_id", "last.metar_id", "observation_time", (F.col("last.change") == "ended").alias("ended"))
