import pytest
from pyspark.sql import functions as F

from ferrule.llm import mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    pool, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        share = {s: (pool - sum(full.values())) * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        full |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100, None: 50}, {"a": 10, "b": 1000, "c": 3, "d": 500, "é": 0}, {"only": 7}, {"a": 0, "b": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_meets_targets(spark):
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"), (F.col("id") * 7919 % 400 + 1).alias("size"))
    once = mixing.mixed(df, strand_rows=50).cache()
    for r in once.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect():
        assert abs(r.taken - r.target) <= 500 and r.most <= 2
    again = mixing.mixed(df.repartition(7), strand_rows=50)
    assert once.exceptAll(again).count() == 0 and once.where("taken > 2 * size").count() == 0


def test_emits_once_per_boundary(spark):
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, "a").otherwise("b").alias("source"), F.lit(10).cast("long").alias("size"))
    rows = mixing.mixed(df).collect()
    for source in "ab":
        own = [r for r in rows if r.source == source]
        each = own[0].target / own[0].source_size
        assert abs(sum(r.copies for r in own) - each * len(own)) < 1 and {r.copies for r in own} <= {int(each), int(each) + 1, 2}


def test_odd_rows(spark, odd, nothing):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(r.taken <= 2 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (3, 4, 8)} == {0}
    assert mixing.mix(nothing).count() == 0
