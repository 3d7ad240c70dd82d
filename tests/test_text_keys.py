"""Folding, canonical JSON and natural order against Python."""

import functools
import json
import random
import unicodedata

from pyspark.sql import functions as F

from ferrule.functions import columns as C
from ferrule.operators import overrides


def fold(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not "̀" <= c <= "ͯ")


def test_folding_of_all_code_points(spark):
    texts = ["".join(f"a{chr(c)}" for c in range(at, min(at + 256, 0x110000))) for at in range(0, 0x110000, 256) if not 0xD800 <= at < 0xE000]
    texts += [None, "", "plain", "Pokémon ﬁn ½ ㎏ 한국어 Ω"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", C.folded(F.col("t")).alias("f")).collect()
    for r in got:
        assert r.f == (None if texts[r.i] is None else fold(texts[r.i])), texts[r.i]


def shuffled(value, rnd):
    if isinstance(value, dict):
        items = [(k, shuffled(v, rnd)) for k, v in value.items()]
        rnd.shuffle(items)
        return dict(items)
    return [shuffled(v, rnd) for v in value] if isinstance(value, list) else value


def test_canonical_json(spark):
    rnd = random.Random(1)
    value = {"b": [1, {"z": None, "a": "q\"\\é\n"}, []], "a": {"B": True, "A": {"deep": {"x": 1.5, "": {}}}}, "é": "", "Z": [[{"k": 2, "j": 1}]]}
    texts = [json.dumps(shuffled(value, rnd), indent=i % 3 or None, ensure_ascii=bool(i % 2)) for i in range(12)]
    got = [r.c for r in spark.createDataFrame([(t,) for t in [*texts, "{bad", "", None]], "t string").select(C.canonical_json(F.col("t")).alias("c")).collect()]
    assert got[:12] == [json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)] * 12 and got[12:] == [None] * 3


def test_natural_order(spark):
    names = ["", "a", "a1", "a2", "a10", "a10b2", "a10b11", "a010c", "A2", "b", "9", "10", "12345678901234567890123", "-x", "é", "f", "a 2", "a 10"]
    want = ["", "-x", "9", "10", "12345678901234567890123", "a"]
    got = [r.n for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(C.natural_key(F.col("n")), "n").collect()]
    assert got[:6] == want and got.index("é") < got.index("f") and got.index("b") < got.index("é")
    for a, b in (("a1", "a2"), ("a2", "a10"), ("a10b2", "a10b11"), ("a 2", "a 10"), ("9", "10")):
        assert got.index(a) < got.index(b)


def plain_log(entity, entries):
    """One entry after another over dicts of leaves and lists."""
    alive, leaves, lists, excluded, created, problems = entity is not None, dict((entity or ({}, {}))[0]), {k: list(v) for k, v in (entity or ({}, {}))[1].items()}, False, False, set()
    order = {op: i for i, op in enumerate(overrides.OPERATIONS)}
    related = lambda a, b: a == b or a.startswith(b + ".") or b.startswith(a + ".")
    for ordinal, op, path, value in sorted(entries, key=lambda e: (e[0], order[e[1]], e[2] or "", e[3] or "")):
        if op == "exclude":
            alive, excluded, leaves, lists = False, True, {}, {}
        elif op == "create":
            if not alive:
                alive, created, leaves, lists = True, True, {}, {}
        elif not alive:
            problems.add(ordinal)
        else:
            had = lists.get(path, [])
            leaves = {k: v for k, v in leaves.items() if not related(k, path)}
            lists = {k: v for k, v in lists.items() if not related(k, path)}
            if op == "set":
                leaves[path] = value
            else:
                lists[path] = [*had, value] if op == "append" and value not in had else [x for x in had if op == "append" or x != value]
    return alive, excluded, created, leaves, lists, len(problems)


def test_logs_equal_plain(spark):
    rnd = random.Random(3)
    paths = ["a", "a.b", "a.b.c", "ab", "t", "t.x"]
    entities = {i: ({p: "0" for p in rnd.sample(["a.b", "ab"], 1)}, {"t": ["x", "y"]}) for i in range(0, 60, 2)}
    entries = [(i, n, op, None if op in ("exclude", "create") else rnd.choice(paths), None if op in ("exclude", "create") else rnd.choice("xyz")) for i in range(60) for n, op in enumerate(rnd.choices(overrides.OPERATIONS, [1, 2, 4, 5, 4], k=rnd.randint(0, 12)))]
    got = overrides.apply_log(
        spark.createDataFrame([(i, *e) for i, e in entities.items()], "id int, leaves map<string,string>, lists map<string,array<string>>"),
        spark.createDataFrame([(*e, "official") for e in entries], "id int, ordinal int, op string, path string, value string, source string"),
    ).collect()
    ids = {e[0] for e in entries} | set(entities)
    assert {r.id for r in got} == ids
    for r in got:
        assert (r.exists, r.excluded, r.created, r.leaves, r.lists, len(r.problems)) == plain_log(entities.get(r.id), [e[1:] for e in entries if e[0] == r.id])
    assert len({functools.reduce(lambda a, b: a + b, map(str, (r.exists, r.excluded, r.created))) for r in got}) >= 5


def test_append_after_remove(spark):
    """What is appended after it was removed stays; what comes back after exclusion starts empty."""
    entity = spark.createDataFrame([("e", {"title": "old"}, {"tags": ["x", "y"]})], "id string, leaves map<string,string>, lists map<string,array<string>>")
    steps = [(1, "remove", "tags", "x"), (2, "append", "tags", "x")]
    log = lambda rows: spark.createDataFrame([("e", *r, None) for r in rows], "id string, ordinal int, op string, path string, value string, source string")
    assert overrides.apply_overrides(entity, log(steps)).first().lists == {"tags": ["y", "x"]}
    back = overrides.apply_log(entity, log([*steps, (3, "exclude", None, None), (4, "set", "title", "lost"), (5, "create", None, None), (5, "set", "title", "new")])).first()
    assert (back.exists, back.created, back.leaves, back.lists, len(back.problems)) == (True, True, {"title": "new"}, {}, 1)
    assert back.touched["title"].confidence == "high"
