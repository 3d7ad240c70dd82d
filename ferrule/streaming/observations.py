"""Observations as a stream: the newest point of each key and day, points older than the key's last day dropped.

The state of a key is its last day and that day's newest point; a micro-batch emits the points it changed. Within a
batch and across batches points count in the order of their ordinal, as in the batch operator. Emitted rows of one
day replace earlier ones, so a sink that is keyed by (key, day) holds what the batch operator gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
OUT, STATE = "user_id long, day date, event_id long, value double", "day int, event_id long"


def _step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames)).sort_values("event_id")
    last_day, last_event = state.get if state.exists else (-(2**31), -1)
    kept = []
    for day, event, value in zip(rows["day"].tolist(), rows["event_id"].tolist(), rows["value"].tolist(), strict=True):
        if day >= last_day and event > last_event:
            if kept and kept[-1][0] == day:
                kept.pop()
            kept.append((day, event, value))
            last_day, last_event = day, event
    state.update((last_day, last_event))
    out = pd.DataFrame([(key[0], pd.Timestamp(0) + pd.Timedelta(days=d), e, v) for d, e, v in kept], columns=["user_id", "day", "event_id", "value"])
    out["day"] = pd.to_datetime(out["day"]).dt.date
    yield out


def upserts(events: DataFrame) -> DataFrame:
    """The changed (user, day) points of a stream of events."""
    points = events.select("user_id", F.unix_date(F.col("ts").cast("date")).alias("day"), "event_id", "value")
    return points.groupBy("user_id").applyInPandasWithState(_step, OUT, STATE, "update", "NoTimeout")


def run(spark: SparkSession, source: str, sink: str, checkpoint: str, files_a_trigger: int | None = None) -> DataFrame:
    """Drains a folder of event files; the newest row of each user and day, as the sink holds them."""
    reader = spark.readStream.schema(SCHEMA)
    if files_a_trigger:
        reader = reader.option("maxFilesPerTrigger", files_a_trigger)

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    done = upserts(reader.parquet(source)).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(append).start()
    done.awaitTermination()
    rows = spark.read.parquet(sink)
    return rows.groupBy("user_id", "day").agg(F.max(F.struct("event_id", "value")).alias("m")).select("user_id", "day", "m.event_id", "m.value")
