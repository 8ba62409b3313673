"""Sliding windows on a stream from one state per key.

Spark's own sliding windows keep a state row for each window that holds a fact, as
many as the window is slides long. Here a key has one state, a ring of daily
partials (sum and count per day); a micro-batch adds its days, emits the windows that
they changed as they then stand, and a timer drops days that no open window
can reach any more. Late rows are dropped by the watermark as everywhere.

``transformWithState`` needs the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``); ``with_rocksdb`` sets it
for queries started inside.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions.scalar import instant_to_ntz, ntz_to_instant

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, old)


class DailyRing(StatefulProcessor):
    """State per key: day -> (sum, count), for windows of ``days`` days that slide by one."""

    def __init__(self, keys: list[str], days: int):
        self.keys, self.days = keys, days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getMapState("ring", "day int", "total long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, list[int]] = {}
        for part in rows:
            part = part.assign(there=part["v"].notna().astype("int64"), v=part["v"].fillna(0).astype("int64"))
            for day, total, n in part.groupby("day", sort=False)[["v", "there"]].sum().itertuples():
                own = new.setdefault(int(day), [0, 0])
                own[0] += int(total)
                own[1] += int(n)
        ring = {int(k[0]): (int(v[0]), int(v[1])) for k, v in self.ring.iterator()}
        for day, (total, n) in new.items():
            was = ring.get(day, (0, 0))
            ring[day] = (was[0] + total, was[1] + n)
            self.ring.updateValue((day,), ring[day])
            self.handle.registerTimer((day + self.days) * DAY_MS)
        starts = sorted({s for day in new for s in range(day - self.days + 1, day + 1)})
        found = []
        for s in starts:
            inside = [ring[d] for d in range(s, s + self.days) if d in ring]
            found.append((*key, s, sum(t for t, _ in inside), sum(n for _, n in inside)))
        if found:
            yield pd.DataFrame(found, columns=[*self.keys, "start", "total", "n"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone = int(expiredTimerInfo.getExpiryTimeInMs() // DAY_MS) - self.days
        if self.ring.containsKey((gone,)):
            self.ring.removeKey((gone,))
        return iter(())

    def close(self) -> None:
        pass


def stream_rolling_ring(stream: DataFrame, key, time: str, value: str, days: int = 7, watermark: str = "1 day", scale: int = 2) -> DataFrame:
    """Sums and counts of ``value`` per key over ``days``-day windows sliding by a day, for update output.

    ``value`` is a decimal of at most 18 digits with ``scale`` decimals, summed as its
    unscaled long. Days are UTC days; a wall-clock time is read as UTC. Output: keys,
    window_start, window_end, ``{value}_sum`` (double, NULL without a value) and ``{value}_count``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ntz = dict(stream.dtypes).get(time) == "timestamp_ntz"
    et = ntz_to_instant(time) if ntz else F.col(time).cast("timestamp")
    rows = stream.select(*keys, et.alias("__et"), (F.col(value) * F.lit(10 ** scale)).cast("bigint").alias("v"))
    rows = rows.where(F.col("__et").isNotNull()).withWatermark("__et", watermark)
    rows = rows.withColumn("day", F.floor(F.unix_seconds("__et") / F.lit(86_400)).cast("int"))
    schema = StructType([f for f in stream.select(*keys).schema]).add("start", "integer").add("total", "long").add("n", "long")
    found = rows.groupBy(*keys).transformWithStateInPandas(DailyRing(keys, days), schema, "Update", "EventTime")
    at = lambda c: F.timestamp_seconds(c.cast("bigint") * 86_400)
    back = instant_to_ntz if ntz else (lambda c: c)
    return found.select(*keys, back(at(F.col("start"))).alias("window_start"), back(at(F.col("start") + days)).alias("window_end"),
                        F.when(F.col("n") > 0, F.col("total").cast("double") / F.lit(float(10 ** scale))).alias(f"{value}_sum"),
                        F.col("n").alias(f"{value}_count"))
