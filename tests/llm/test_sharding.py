import zlib

from pyspark.sql import functions as F

from ferrule.llm import sharding


def check(rows, shards=24):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_sizes_are_near_equal_and_groups_stay(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("t"), (F.col("id") - F.col("id") % 2).cast("string")), (F.col("id") % 7 + 1 - F.col("id") % 2 * 0).cast("int")).alias("text"))
    rows = sharding.sharded(df).collect()
    check(rows)
    total = {}
    for r in rows:
        total[r.shard] = total.get(r.shard, 0) + r.size
    mean = sum(total.values()) / 24
    assert len(total) == 24 and max(total.values()) < 1.03 * mean and min(total.values()) > 0.97 * mean


def test_equal_texts_share_a_shard(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), (F.col("id") % 1000).cast("string")).alias("text"))
    rows = sharding.sharded(df).collect()
    check(rows)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id % 1000, set()).add(r.shard)
    assert all(len(s) == 1 for s in of.values())


def test_a_hot_group_is_divided(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the hot one, always the same").otherwise(F.concat(F.lit("other "), F.col("id").cast("string"), F.lit(" with some length"))).alias("text"))
    rows = sharding.sharded(df).collect()
    check(rows)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(24)]
    assert max(sizes) < 1.05 * min(sizes)
    assert {r.text_crc32 for r in rows if r.doc_id == 0} == {zlib.crc32(b"the hot one, always the same")}


def test_odd_rows(spark, odd, nothing):
    rows = sharding.sharded(odd).collect()
    assert len(rows) == odd.count() and min(r.size for r in rows) == 8
    check(rows)
    assert sharding.sharded(nothing).count() == 0


def test_native_plan(spark, odd):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        sharding.sharded(odd).explain("formatted")
    assert not any(word in out.getvalue() for word in ("Python", "Pandas", "Arrow"))
