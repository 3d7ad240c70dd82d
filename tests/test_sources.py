import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ferrule.sources import eav, files


def test_text_and_json(spark, tmp_path):
    (tmp_path / "a.txt").write_text("﻿hello\nworld", encoding="utf-8")
    assert files.read_text(spark, str(tmp_path / "a.txt")).first().text == "hello\nworld"
    (tmp_path / "b.json").write_text(json.dumps([{"id": 1, "tags": ["x"]}]))
    assert files.read_json(spark, str(tmp_path / "b.json"), "id long, tags array<string>").first() == (1, ["x"])
    assert files.read_json(spark, str(tmp_path / "none.json"), "id long", missing_ok=True).count() == 0
    assert files.read_parquet_or_empty(spark, str(tmp_path / "none"), "id long").count() == 0
    (tmp_path / "c.json").write_text('{"id": "x"')
    with pytest.raises(Exception):  # noqa: B017
        files.read_json(spark, str(tmp_path / "c.json"), "id long").collect()
    assert files.listing(spark, str(tmp_path)).count() == 3


def test_seeds(spark):
    df = files.seeds(spark, [{"id": "a"}, {"id": "b", "discover": False}], "id string, discover boolean", {"discover": True})
    assert sorted(map(tuple, df.collect())) == [("a", True), ("b", False)]
    with pytest.raises(ValueError):
        files.seeds(spark, [{"id": "a", "colour": 1}], "id string", {})


def test_cached_responses(spark):
    at = dt.datetime(2026, 1, 1)
    rows = [("a", at, 200, "old"), ("a", at + dt.timedelta(days=3), 200, "new"), ("b", at, 200, "b"), ("c", at + dt.timedelta(days=4), 404, "x")]
    raw = spark.createDataFrame(rows, "key string, fetched_at timestamp_ntz, status int, body string")
    assert sorted(map(tuple, files.cached_responses(raw, "2026-01-06", 3).collect())) == [("a", 200, "new"), ("c", 404, None)]
    assert files.cached_responses(raw, "2026-01-06", 3, offline=True).count() == 3


def test_publish_only_changes(spark, tmp_path):
    df = spark.range(20).withColumn("x", F.col("id") % 3)
    path = str(tmp_path / "t")
    one = files.publish(df, path, ["id"])
    before = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert files.publish(df.repartition(3), path, ["id"]) == one and sorted(p.name for p in (tmp_path / "t").iterdir()) == before
    assert files.publish(df.where("id > 0"), path, ["id"]) != one and spark.read.parquet(path).count() == 19
    files.snapshot(df, str(tmp_path / "s"), "2026-01")
    with pytest.raises(Exception):  # noqa: B017
        files.snapshot(df, str(tmp_path / "s"), "2026-01")
    assert json.loads(files.json_schema(df.schema, "t"))["items"]["properties"]["id"] == {"type": "integer"}


def test_statements(spark):
    s = spark.createDataFrame([("i", "p", "v2", "b", 1), ("i", "p", "v1", "a", 2), ("i", "p", "v1", "z", 3), ("i", "q", "_:x", "n", 4), ("j", "q", "w", "w", 5)], "item string, property string, value string, label string, ordinal int")
    assert [(r.item, r.property, [tuple(v) for v in r["values"]]) for r in eav.pairs(s).orderBy("item").collect()] == [("i", "p", [("a", "v1"), ("b", "v2")]), ("j", "q", [("w", "w")])]
    d = spark.createDataFrame([("i", "+2020-05-01T00:00:00Z", 10, "normal"), ("i", "+2019-01-01T00:00:00Z", 11, "deprecated"), ("j", "+2021-02-03T00:00:00Z", 11, "preferred")], "item string, time string, precision int, rank string")
    assert sorted(map(tuple, eav.earliest_dates(d).collect())) == [("i", "2020-05"), ("j", "2021-02-03")]
    t = spark.createDataFrame([("i", "demo"), ("i", "game"), ("j", "odd")], "item string, type string")
    assert list(map(tuple, eav.chosen_type(t, ["game", "demo"]).collect())) == [("i", "game")]


def test_stream_matches_batch(spark, tmp_path):
    from ferrule.operators.core import observations
    from ferrule.streaming import observations as stream

    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=(i * 37) % 200 + i), i % 4, "click", float(i), "{}") for i in range(120)]
    events = spark.createDataFrame(rows, stream.SCHEMA)
    for n in range(3):  # three files, read one a trigger, in order
        events.where(f"event_id div 40 = {n}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = stream.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), 1)
    want = observations(events.select("user_id", "event_id", F.col("ts").cast("date").alias("day"), "value"), "user_id", "day", "event_id")
    assert sorted(map(tuple, got.select("user_id", "day", "event_id", "value").collect())) == sorted(map(tuple, want.select("user_id", "day", "event_id", "value").collect()))
