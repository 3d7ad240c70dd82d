"""Providers on files and the rounds that ask them, against a plain walk."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ferrule.operators.enrichment import enrich
from ferrule.sources import provider as P

SHAPE = "ids array<string>, record string"


def ask(spark, path):
    return lambda asked: P.fetch_fixture(spark, path, asked)


def reached(seeds, tables):
    known, got = set(seeds), set()
    while True:
        new = {(name, tuple(sorted(ids)), record) for name, rows in tables.items() for ids, record in rows if known & set(ids)}
        if new == got:
            return got
        got, known = new, known | {i for _, ids, _ in new for i in ids}


def fetched(df):
    return {(r.provider, tuple(r.ids), r.record) for r in df.collect()}


def test_rounds_until_nothing_is_new(spark, tmp_path):
    rng = random.Random(4)
    tables = {name: [(sorted({f"i{rng.randrange(60)}" for _ in range(2)}), f"{name} {n}") for n in range(25)] for name in ("store", "wiki")}
    tables["store"].extend(([f"c{n}", f"c{n + 1}"], f"chain {n}") for n in range(4))
    tables = {name: list({tuple(ids): (ids, r) for ids, r in rows}.values()) for name, rows in tables.items()}
    for name, rows in tables.items():
        P.write_fixture(spark.createDataFrame(rows, SHAPE), str(tmp_path / name))
    seeds = ["i1", "i2", "c0", None, "nowhere"]
    got, status = enrich(spark, spark.createDataFrame([(s,) for s in seeds], "id string"), {n: ask(spark, str(tmp_path / n)) for n in tables})
    want = reached({s for s in seeds if s}, tables)
    assert ("store", ("c3", "c4"), "chain 3") in want and len(want) < sum(map(len, tables.values()))
    assert fetched(got) == want
    assert {tuple(r) for r in status.collect()} == {("store", "ok", None), ("wiki", "ok", None)}


def test_a_failing_provider_is_carried_over(spark, tmp_path):
    P.write_fixture(spark.createDataFrame([(["a", "b"], "new")], SHAPE), str(tmp_path / "store"))
    broken = tmp_path / "broken" / f"bucket={spark.range(1).select(P.bucket_of(F.lit('a'))).first()[0]}"
    broken.mkdir(parents=True)
    (broken / "x.json").write_text(json.dumps({"id": "a", "ids": ["a"], "record": "r"}) + "\n{no json\n")
    previous = spark.createDataFrame([("store", ["z"], "old"), ("broken", ["a"], "kept"), ("missing", ["a", "q"], "kept too")], "provider string, ids array<string>, record string")
    asked = {n: ask(spark, str(tmp_path / n)) for n in ("store", "broken", "missing")}
    got, status = enrich(spark, spark.createDataFrame([("a",)], "id string"), asked, previous)
    assert {(r.provider, tuple(r.ids), r.record, r.state) for r in got.collect()} == {("store", ("a", "b"), "new", "fetched"), ("broken", ("a",), "kept", "carried"), ("missing", ("a", "q"), "kept too", "carried")}
    assert {(r.provider, r.status) for r in status.collect()} == {("store", "ok"), ("broken", "error"), ("missing", "error")}
    assert all(r.detail for r in status.where("status = 'error'").collect())


def test_files_of_other_buckets_stay_closed(spark, tmp_path):
    path = str(tmp_path / "all")
    P.write_fixture(spark.createDataFrame([([f"k{n}", None, f"k{n}"], None) for n in range(200)], SHAPE), path)
    reader = P.FixtureReader(path)
    every = len(reader.partitions())
    rest = list(reader.pushFilters([P.EqualTo(("bucket",), 3), P.EqualTo(("id",), "k1")]))
    assert [f.attribute for f in rest] == [("id",)]
    assert {p.bucket for p in reader.partitions()} == {3} and every > 30
    got = P.fetch_fixture(spark, path, spark.createDataFrame([("k7",), ("k7",), ("none",)], "id string"))
    assert [tuple(r) for r in got.collect()] == [(["k7"], "")]
    assert P.fetch_fixture(spark, path, spark.createDataFrame([], "id string")).collect() == []


@pytest.mark.parametrize("providers", [True, False])
def test_nothing_to_ask(spark, providers):
    def never(asked):
        raise AssertionError

    got, status = enrich(spark, spark.createDataFrame([] if providers else [("a",)], "id string"), {"p": never} if providers else {})
    assert got.collect() == [] and status.count() == providers
