"""The thinned history of a stream, over several batches and restarts, against the batch operator and a plain version."""

import datetime
import random

from pyspark.sql import functions as F

from ferrule.operators.core import thinned_history
from ferrule.streaming import history as H

SHAPE = "key long, day date, ordinal long, value double"
START = datetime.date(2020, 1, 1)


def made(seed, days, keys, each):
    """Points of a span of days, in the order of days but for a shuffle within a week."""
    rng = random.Random(seed)
    rows = [(rng.randrange(keys), START + datetime.timedelta(rng.randrange(days)), n, rng.choice([None, float("nan"), float(rng.randrange(9))])) for n in range(each)]
    return sorted(rows, key=lambda r: (r[1].toordinal() // 7, r[2]))


def stream(spark, folder):
    return spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(folder)


def put(spark, rows, folder, n):
    spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(f"{folder}/part={n}")


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select("key", "day", "ordinal", "value").collect())


def wanted(spark, rows, days):
    points = spark.createDataFrame(rows, SHAPE).groupBy("key", "day").agg(F.max(F.struct("ordinal", "value")).alias("m")).select("key", "day", "m.*")
    today = max(r[1] for r in rows)
    return rows_of(thinned_history(points, "key", "day", F.lit(today), days))


def test_batches_and_a_restart(spark, tmp_path):
    rows = made(3, 300, 5, 240) + [(9, START + datetime.timedelta(d), 1000 + d, 1.0) for d in range(40)]
    rows.sort(key=lambda r: (r[1].toordinal() // 7, r[2]))
    source, sink, offsets = (str(tmp_path / x) for x in ("in", "out", "offsets"))
    for n in range(2):
        put(spark, rows[n * 70 : n * 70 + 70], source, n)
    H.run(spark, stream(spark, source), sink, offsets, days=60, lateness="7 days")
    put(spark, rows[140:], source, 2)
    out = H.run(spark, stream(spark, source), sink, offsets, days=60, lateness="7 days")
    assert rows_of(H.history(out, days=60)) == wanted(spark, rows, 60)
    # a key that has been silent since its fortieth day was thinned by its timer, in the state and in the sink
    silent = [r.day for r in out.where("key = 9").groupBy("day").agg(F.bool_and("kept").alias("kept")).where("kept").collect()]
    assert len(silent) == 2 and out.where("key = 9 and not kept").count() == 38


def test_nulls_repeats_and_nothing(spark, tmp_path):
    day = START
    rows = [(1, day, 5, 1.0), (1, day, 5, 1.0), (1, day, 4, 9.0), (None, day, 1, 1.0), (1, None, 1, 1.0), (1, day, None, 1.0), (2, day, 1, None)]
    source, sink, offsets = (str(tmp_path / x) for x in ("in", "out", "offsets"))
    put(spark, rows, source, 0)
    out = H.run(spark, stream(spark, source), sink, offsets)
    assert rows_of(H.history(out)) == sorted(map(str, [(1, day, 5, 1.0), (2, day, 1, None)]))
    assert H.history(spark.createDataFrame([], H.CHANGE)).collect() == []


def test_thinning_of_a_dictionary():
    points = {d: (d, 0.0) for d in (0, 5, 31, 40, 100, 130)}
    assert set(H.thinned(points, 140, 20)) == {0, 31, 100, 130}
    assert set(H.thinned(points, 0, 20)) == set(points)
