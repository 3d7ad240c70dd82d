"""Ids given all at once equal ids given one after another."""

import random

import pytest
from pyspark.sql import functions as F

from ferrule.operators import core, ids


def one_by_one(things, taken):
    taken, out = set(taken), {}
    for key, names in sorted(x for x in things if x[0] is not None and x[1]):
        free = next((n for n in names if n not in taken), None)
        n = 2
        while free is None:
            free, n = (f"{names[0]}-{n}" if f"{names[0]}-{n}" not in taken else None), n + 1
        taken.add(free)
        out[key] = free
    return out


def all_at_once(spark, things, taken, family):
    got = ids.allocate(spark.createDataFrame(things, "key long, candidates array<string>"), spark.createDataFrame([(t,) for t in taken], "id string"), family).collect()
    assert len({r.id for r in got}) == len(got) and not {r.id for r in got} & set(taken)
    return {r.key: r.id for r in got}


CASES = [
    ([(1, ["doom"]), (2, ["doom"]), (3, ["doom-2"])], []),
    ([(1, ["doom-2"]), (2, ["doom"]), (3, ["doom"]), (4, ["doom"])], ["doom-3"]),
    ([(1, ["a", "b"]), (2, ["b"]), (3, ["a", "b"]), (4, ["a", "a-1999"]), (5, ["a", "a-1999"])], ["a"]),
    ([(i, ["x"]) for i in range(30)] + [(100 + i, [f"x-{i}"]) for i in range(20)], ["x-5", "x-6", "x-7", "x-02", "x-"]),
    ([(100 + i, ["x"]) for i in range(30)] + [(i, [f"x-{i}"]) for i in range(20)], []),
    ([(1, ["x"]), (2, ["x"])], [f"x-{i}" for i in range(2, 200)]),
    ([(1, ["x-2"]), (2, ["x-2"]), (3, ["x"]), (4, ["x-2-2"]), (None, ["x"]), (5, None), (6, [])], ["x"]),
    ([(1, ["x-1990"]), (2, ["y", "x-1990"]), (3, ["y", "x"]), (4, ["z"]), (5, ["z", "y"])], []),
    ([], ["x"]),
]


def random_case(seed):
    rng = random.Random(seed)
    name = lambda: rng.choice("ab") + "".join(f"-{rng.randint(2, 5)}" for _ in range(rng.choice((0, 0, 0, 1, 1, 2))))
    return [(i, [name() for _ in range(rng.choice((1, 2)))]) for i in range(40)], {name() for _ in range(6)}


@pytest.mark.parametrize("family", [0, 15, ids.FAMILY])
def test_equal_to_one_by_one(spark, family):
    """In rounds, in both ways, and in order; all cases at once, each with names and keys of its own."""
    things, taken, want = [], [], {}
    for at, (some, gone) in enumerate([*CASES, *map(random_case, range(6))]):
        own = [(None if k is None else 1000 * at + k, None if names is None else [f"c{at}q{n}" for n in names]) for k, names in some]
        things, taken = things + own, taken + [f"c{at}q{x}" for x in gone]
        want |= one_by_one(own, [f"c{at}q{x}" for x in gone])
    assert all_at_once(spark, things, taken, family) == want


def test_stable_ids(spark):
    """Mapped, then registered, then new; of several registered ids the preferred provider's; the rest is told."""
    clusters = spark.createDataFrame([(1, ["steam:1", "igdb:9"], ["doom", "doom-1993"]), (2, ["steam:2"], ["doom"]), (3, ["igdb:3", "steam:3"], ["quake"]), (4, ["wikidata:4"], ["doom", "doom-2016"]), (5, ["wikidata:5"], ["old"])], "key long, ids array<string>, candidates array<string>")
    mapped = spark.createDataFrame([("steam:2", "doom-classic")], "key string, id string")
    registry = spark.createDataFrame([("igdb:3", "quake-a"), ("steam:3", "quake-z"), ("steam:77", "doom")], "key string, id string")
    previous = spark.createDataFrame([("old",), ("old-2",)], "id string")
    got = {r.key: (r.id, r.others) for r in ids.stable_ids(clusters, mapped, registry, previous, "steam:").collect()}
    assert got == {1: ("doom-1993", []), 2: ("doom-classic", []), 3: ("quake-z", ["quake-a"]), 4: ("doom-2016", []), 5: ("old-3", [])}


def test_running(spark):
    """Sums and maxima of a key that lies in several parts."""
    rows = [(k, i, (i * 37) % 11) for k in "abc" for i in range(50 if k == "b" else 3)]
    got = core.running(spark.createDataFrame(rows, "k string, i int, v int"), "k", ["i"], parts=7, total=("sum", F.col("v")), most=("max", F.col("v"))).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [v for k, i, v in rows if k == r.k and i <= r.i]
        assert (r.total, r.most) == (sum(own), max(own))
