"""A thinned history as a stream: all points of the last days, of older months the first, with state that shrinks.

The state of a key is the list of its points, at most one a day for the last `days` days and one a month before; what is
older is thinned inside the state, when rows of the key come and by a timer when it stays silent. Today is the stream's
watermark, the newest day of any key less the lateness that is allowed. A day that is thinned away has an earlier day of
its month in the state for good, so it never comes back: the sink takes points and drops in any order, and a batch that
runs again after a failure replaces its own rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ferrule.operators.core import thinned_history

DAY_MS = 86_400_000
POINT, CHANGE = "day int, ordinal long, value double", "key long, day int, ordinal long, value double, kept boolean"
PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _month(day: int) -> tuple[int, int]:
    from datetime import date

    on = date.fromordinal(day + 719_163)
    return on.year, on.month


def _weight(ordinal: int, value: float | None) -> tuple[int, int, float]:
    """The order in which Spark sorts (ordinal, value): nulls first, NaN last."""
    if value is None:
        return ordinal, 0, 0.0
    return (ordinal, 2, 0.0) if math.isnan(value) else (ordinal, 1, value)


def thinned(points: dict[int, tuple], today: int, days: int) -> dict[int, tuple]:
    """The points that stay: those of the last days, and the first of each month before."""
    first: dict[tuple[int, int], int] = {}
    for day in sorted(points):
        if day < today - days:
            first.setdefault(_month(day), day)
    return {day: p for day, p in points.items() if day >= today - days or first[_month(day)] == day}


class Thinning(StatefulProcessor):
    """Keeps each key's thinned points and gives what changes: a point as it now is, or the drop of a day."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.points = handle, handle.getListState("points", POINT)

    def _settle(self, key: Any, before: dict[int, tuple], now: dict[int, tuple], timers: Any) -> Iterator[Row]:
        today = timers.getCurrentWatermarkInMs() // DAY_MS
        after = thinned(now, today, self.days)
        if after != before:
            self.points.put([(day, *after[day]) for day in sorted(after)])
        waiting = [day for day in after if day >= today - self.days]
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if waiting:  # the moment at which the oldest of the last days' points gets old
            self.handle.registerTimer((min(waiting) + self.days + 1) * DAY_MS)
        for day, point in after.items():
            if before.get(day) != point:
                yield Row(key=key[0], day=day, ordinal=point[0], value=point[1], kept=True)
        for day in now.keys() - after.keys():
            if day in before:
                yield Row(key=key[0], day=day, ordinal=before[day][0], value=before[day][1], kept=False)

    def _known(self) -> dict[int, tuple]:
        return {p[0]: (p[1], p[2]) for p in self.points.get()} if self.points.exists() else {}

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = self._known()
        now = dict(before)
        for r in rows:
            if r.day not in now or _weight(r.ordinal, r.value) > _weight(*now[r.day]):
                now[r.day] = (r.ordinal, r.value)
        yield from self._settle(key, before, now, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        before = self._known()
        yield from self._settle(key, before, before, timerValues)


def changes(points: DataFrame, days: int = 400, lateness: str = "0 days") -> DataFrame:
    """(key, day, ordinal, value, kept) of a stream of (key long, day date, ordinal long, value double).

    Of a day's points the one of the greatest ordinal counts. Rows whose key, day or ordinal is null are left out; a row
    more than `lateness` behind the newest day of earlier batches comes too late and is dropped.
    """
    day = F.unix_date("day")
    rows = points.where("key is not null and day is not null and ordinal is not null").select("key", day.alias("day"), "ordinal", "value", F.timestamp_seconds(day.cast("long") * 86_400).alias("at"))
    return rows.withWatermark("at", lateness).groupBy("key").transformWithState(Thinning(days), CHANGE, "Update", "EventTime")


def history(sink: DataFrame, today: Column | None = None, days: int = 400) -> DataFrame:
    """(key, day, ordinal, value) as the rows of a sink have it, thinned up to today (none: the newest day)."""
    point = F.max(F.struct("ordinal", "value"))
    kept = sink.groupBy("key", F.date_from_unix_date("day").alias("day")).agg(point.alias("m"), F.bool_and("kept").alias("kept")).where("kept").select("key", "day", "m.ordinal", "m.value")
    if today is None:
        newest = sink.agg(F.date_from_unix_date(F.max("day")).alias("_today"))  # one row
        return thinned_history(kept.crossJoin(F.broadcast(newest)), "key", "day", F.col("_today"), days).drop("_today")
    return thinned_history(kept, "key", "day", today, days)


def run(spark: SparkSession, points: DataFrame, sink: str, checkpoint: str, days: int = 400, lateness: str = "0 days") -> DataFrame:
    """Drains a stream of points into a folder of Parquet, goes on where the checkpoint stands; the sink's rows."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    earlier = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # state that is more than one value lies in RocksDB
    try:
        started = changes(points, days, lateness).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
        started.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, earlier)
    return spark.read.schema(CHANGE).parquet(sink)
