"""Shared operators on small tables, against models and laws."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrule.operators import core, resolver
from ferrule.plans.merging import patched


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=30))
def test_components(spark, edges):
    root = list(range(26))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in core.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges for n in e}


def test_components_of_a_chain(spark):
    got = core.components(spark.createDataFrame([(i, i + 1) for i in range(120)], "a long, b long"))
    assert got.where("root <> 0").count() == 0 and got.count() == 121


def test_velocity(spark):
    rows = [(1, 100, 1000), (1, 130, 1300), (2, 100, 10), (2, 103, 20), (3, 1, 50), (3, 40, 20), (4, 1, 0), (4, 30, 9)]
    got = {r.k: r for r in core.velocity(spark.createDataFrame(rows, "k int, day int, total int"), "k", "day", "total", 30).collect()}
    assert (got[1].per_day, got[1].growth, got[1].growth_percent, got[1].window_days) == (10.0, 300, 30.0, 30)
    assert got[2].per_day is None and got[2].observations == 2
    assert got[3].per_day == 0.0 and got[3].growth == -30
    assert got[4].growth_percent is None and got[4].per_day > 0


def test_observations(spark):
    rows = [(1, dt.date(2024, 1, 2), 1, 5), (1, dt.date(2024, 1, 2), 2, 6), (1, dt.date(2024, 1, 1), 3, 9), (1, dt.date(2024, 1, 3), 4, 7)]
    got = core.observations(spark.createDataFrame(rows, "k int, d date, n int, v int"), "k", "d", "n")
    assert sorted((r.d.day, r.v) for r in got.collect()) == [(2, 6), (3, 7)]


def test_thinned_history(spark):
    rows = [(1, dt.date(2023, 1, 1) + dt.timedelta(days=i)) for i in range(60)]
    got = core.thinned_history(spark.createDataFrame(rows, "k int, d date"), "k", "d", F.to_date(F.lit("2026-01-01")))
    assert sorted(r.d for r in got.collect()) == [dt.date(2023, 1, 1), dt.date(2023, 2, 1), dt.date(2023, 3, 1)]


def test_priority_pick(spark):
    rows = [(1, "b", 2, 1), (1, "", 1, 1), (1, "a", 3, 1), (2, "x", None, 1), (3, "c", 1, 2), (3, "c", 2, 1)]
    got = {r.k: (r.v, r.alternatives) for r in core.priority_pick(spark.createDataFrame(rows, "k int, v string, rank int, n int"), ["k"], "v", "rank", "n").collect()}
    assert got == {1: ("b", ["a"]), 3: ("c", [])}


def test_patches_are_ordered_and_idempotent(spark):
    base = spark.createDataFrame([(1, "t", ["x", "y"]), (2, "u", ["x"])], "id int, title string, tags array<string>")
    entries = spark.createDataFrame([(1, 1, "set", "title", "a"), (1, 2, "set", "title", "b"), (1, 3, "append", "tags", "z"), (1, 4, "append", "tags", "x"), (1, 5, "remove", "tags", "y")], "id int, ordinal int, op string, path string, value string")
    once = patched(base, entries)
    assert {r.id: (r.title, r.tags) for r in once.collect()} == {1: ("b", ["x", "z"]), 2: ("u", ["x"])}
    again = patched(once.drop("touched"), entries)
    assert sorted(map(tuple, again.drop("touched").collect())) == sorted(map(tuple, once.drop("touched").collect()))


def test_snapshot_changes(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 2)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", 5), (2, "w", 1), (4, "q", 1)], "k int, s string, n int")
    assert sorted(map(tuple, core.snapshot_changes(a, b, "k", ["s", "n"]).collect())) == [(1, "n", None, "5"), (2, "s", "y", "w")]


def test_resolver_prefers_earlier_evidence_and_learns(spark):
    known = spark.createDataFrame([(7, "acme"), (5, "bolt"), (9, "acme")], "id int, value string")
    refs = spark.createDataFrame([(1, "acme", "x1"), (2, None, "x1"), (3, None, "x2"), (4, "bolt", None)], "ref int, name string, ext string")
    got = {r.ref: (r.id, r.round) for r in resolver.learn(refs, known).collect()}
    assert got == {1: (7, 1), 2: (7, 2), 4: (5, 1)}


def test_top_by_breaks_ties(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, v int")
    assert [(r.id, r.rank) for r in core.top_by(df, [F.col("v").desc(), F.col("id")], 4).collect()] == [(2, 1), (5, 2), (8, 3), (1, 4)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert core.components(none).count() == 0
    assert core.velocity(spark.createDataFrame([], "k int, day int, total int"), "k", "day", "total", 30).count() == 0
