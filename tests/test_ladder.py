"""The evidence ladder against a plain version that goes through one reference after another."""

import random

import pytest
from pyspark.sql import functions as F

from ferrule.operators import resolver

PROVIDERS = resolver.PROVIDERS


def exact(name):
    words = name.lower().replace(".", " ").split()
    while len(words) > 1 and words[-1] == "inc":
        words.pop()
    return " ".join(words)


def loose(name):
    words = exact(name).split()
    while words and words[-1] in ("games", "studios"):
        words.pop()
    return " ".join(words)


def differ(a, b):
    return any(a[p] and b[p] and a[p] != b[p] for p in PROVIDERS)


def plain(ref, entries, mapped_ids, mapped_names, registry, distinct):
    ids = [f"{p}:{ref[p]}" for p in PROVIDERS if ref[p]]
    for k in ids:
        if k in mapped_ids:
            return mapped_ids[k], "mapping"
    if ref["name"] in mapped_names:
        return mapped_names[ref["name"]], "mapping"
    for n in sorted(mapped_names):
        if exact(n) == exact(ref["name"]):
            return mapped_names[n], "mapping"
    known = {}
    for e in sorted(entries, key=lambda e: (not e["seeded"], e["id"])):
        for p in PROVIDERS:
            if e[p]:
                known.setdefault(f"{p}:{e[p]}", e["id"])
    for k in ids:
        if k in known:
            return known[k], "external-id"
        if k in registry:
            return registry[k], "registry"
    names = {e["id"]: [e["name"], *e["aliases"]] for e in entries}

    def fold():
        own = loose(ref["name"])
        if not own:
            return None
        tight = own.replace(" ", "")
        near = lambda n: loose(n) and (loose(n) == own or (len(tight) >= 5 and loose(n).replace(" ", "") == tight))
        group = [e for e in entries if any(near(n) for n in names[e["id"]]) and not differ(e, ref)]
        if not group or any(a["id"] != b["id"] and (differ(a, b) or {a["id"], b["id"]} in distinct) for a in group for b in group):
            return None
        seeded = [e for e in group if e["seeded"]]
        if len(seeded) > 1:
            return None
        short = [e for e in group if own in map(exact, names[e["id"]])]
        chosen = (seeded or [min(group, key=lambda e: e["id"])])[0]
        if not short and any(e["id"] != chosen["id"] and exact(n).startswith(own + " ") and loose(exact(n)) != own for e in entries for n in names[e["id"]]):
            return None
        if seeded:
            return chosen["id"]
        pool = short or group
        with_id = [e for e in pool if any(e[p] for p in PROVIDERS)]
        return min(with_id if len(with_id) == 1 else pool, key=lambda e: (len(e["name"]), e["id"]))["id"]

    found = [e for e in entries if exact(ref["name"]) in map(exact, names[e["id"]]) and not differ(e, ref)]
    folded = fold()
    if len(found) == 1:
        e = found[0]
        if folded is not None and folded != e["id"]:
            return folded, "normalized-name"
        return e["id"], "name" if e["name"] == ref["name"] else "normalized-name"
    if found:
        seeded = [e for e in found if e["seeded"]]
        return folded if folded is not None else (seeded[0]["id"] if len(seeded) == 1 else min(e["id"] for e in found)), "normalized-name"
    if folded is not None:
        return folded, "normalized-name"
    by_name = registry.get(f"name:{exact(ref['name'])}")
    entry = next((e for e in entries if e["id"] == by_name), None)
    if by_name is not None and not (entry and differ(entry, ref)):
        return by_name, "registry"
    return None, None


@pytest.mark.parametrize("seed", range(3))
def test_ladder(spark, seed):
    rnd = random.Random(seed)
    bases = ["alpha", "alpha beta", "team 17", "team17", "gamma", "delta ray", "deltaray", "omega"]
    name = lambda: (rnd.choice(bases) + rnd.choice(["", "", " inc", " games", " studios", " games inc", " publishing"])).title()
    some = lambda n: rnd.choice([None, None, None, *(f"x{i}" for i in range(n))])
    entries = [{"id": i, "name": name(), "aliases": [name()] if rnd.random() < 0.3 else [], "seeded": rnd.random() < 0.2, **{p: some(25) for p in PROVIDERS}} for i in range(1, 15)]
    refs = [{"ref": i, "name": name(), **{p: some(40) for p in PROVIDERS}} for i in range(150)]
    mapped_ids = {"wikidata:x3": 1, "steam:x5": 2}
    mapped_names = {name(): 3}
    registry = {"igdb:x7": 4, "steam:x30": 5, f"name:{exact(name())}": 6, "name:omega publishing": 90}
    distinct = [{entries[0]["id"], entries[3]["id"]}, {entries[1]["id"], entries[2]["id"]}]
    kv = lambda d, k: spark.createDataFrame(list(d.items()), f"{k} string, id long")
    got = resolver.match_companies(
        spark.createDataFrame(refs, "ref long, name string, steam string, wikidata string, igdb string"),
        spark.createDataFrame(entries, "id long, name string, aliases array<string>, seeded boolean, steam string, wikidata string, igdb string"),
        kv(mapped_ids, "key"), kv(mapped_names, "name"), kv(registry, "key"), spark.createDataFrame([tuple(sorted(d)) for d in distinct], "a long, b long"),
    ).collect()
    assert len(got) == len(refs)
    want = {r["ref"]: plain(r, entries, mapped_ids, mapped_names, registry, distinct) for r in refs}
    assert {r.ref: (r.id, r.method) for r in got} == want
    assert len({m for _, m in want.values()}) >= 4


def test_similar_names_are_complete(spark):
    from ferrule.functions.columns import _jaro_winkler

    rnd = random.Random(4)
    names = {"".join(rnd.choices("abcde ", k=rnd.randrange(1, 9))).strip() for _ in range(120)} | {"cold widget", "old widget", "widget cold", "martha", "marhta", "dixon", "dicksonx"}
    names = sorted(names - {""})

    def score(a, b):
        x, y = set(a.split()), set(b.split())
        return max(_jaro_winkler(a, b), len(x & y) / len(x | y) if x and y else 0)

    for threshold in (0.85, 0.93):
        got = {(r.a, r.b) for r in resolver.similar_names(spark.createDataFrame([(n,) for n in names], "n string"), "n", threshold).collect()}
        want = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if int(score(a, b) * 10000 + 0.5) / 10000 >= threshold}
        assert got == want and len(want) > 5


def test_suggestions(spark):
    entries = spark.createDataFrame([(1, "The Hollow Lantern Studio"), (2, "Quiet Harbor Games"), (3, "Hollow Lantern Inc")], "id long, name string")
    got = resolver.suggested_links(spark.createDataFrame([("Hollow Lanterns",), ("Quite Harbor",), ("Nothing Alike",)], "n string"), "n", entries).collect()
    assert {r.name: r.suggestion for r in got} == {"Hollow Lanterns": 1, "Quite Harbor": 2}


def test_companies_of_a_key_are_not_listed(spark):
    """A name that thousands of companies share is one row a set of providers, not a list beside each reference."""
    some = spark.range(1, 3001).select("id", F.lit("House of Cards Games").alias("name"), (F.col("id") == 17).alias("seeded"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id"))).alias("steam"), *(F.lit(None).cast("string").alias(p) for p in PROVIDERS[1:]))
    kv = spark.createDataFrame([], "key string, name string, id long")
    apart = spark.createDataFrame([(1, 2)], "a long, b long")
    refs = some.select((F.col("id") + 5000).alias("ref"), F.lit("House of Cards Inc").alias("name"), F.when(F.col("id") % 2 == 0, "t").alias("steam"), *PROVIDERS[1:])
    found = resolver.match_companies(refs, some.withColumn("aliases", F.lit(None).cast("array<string>")), kv, kv, kv, apart)
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in found.groupBy("id", "method").count().collect()] == [(None, None, 3000)]
    found = resolver.match_companies(refs, some.withColumn("aliases", F.lit(None).cast("array<string>")), kv, kv, kv, apart.limit(0))
    got = {tuple(r) for r in found.groupBy(F.col("ref") % 2, "id", "method").count().collect()}
    assert got == {(0, 17, "normalized-name", 1500), (1, None, None, 1500)}


def test_names_meet_at_whole_subsets(spark):
    """Twelve letters of sixteen: names meet a few partners each, and none is lost."""
    from ferrule.functions.columns import _jaro_winkler

    rnd, names = random.Random(8), set()
    for _ in range(150):
        base = "".join(rnd.choices("abcdefghijklmnop", k=12))
        at = rnd.randrange(11)
        names |= {base, base[1:], base[:5] + base[6] + base[5] + base[7:], base[:at] + base[at + 1 :], base[:4] + "".join(rnd.sample(base[4:], 8)), base[:8] + "zz" + base[10:]}
    names = sorted(names)
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    for threshold in (0.85, 0.93):
        got = {(r.a, r.b) for r in resolver.similar_names(rows, "name", threshold).collect()}
        assert got == {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if int(_jaro_winkler(a, b) * 10000 + 0.5) / 10000 >= threshold}
    plan = resolver._subset_plan([10, 11, 12], 0.93)
    keyed = rows.mapInPandas(lambda b: resolver._subsets(b, plan), "name string, key long")
    met = keyed.join(keyed.withColumnRenamed("name", "other"), "key").where("name < other").select("name", "other").distinct()
    assert met.count() < 6 * len(names)


def test_scores_that_are_rounded_up_to_the_threshold(spark):
    """Names just below the threshold whose score of four digits is the threshold."""
    stem = "abcdefghijklmnopqrst"
    pairs = [(stem + "uv", stem + "0123456")]  # 0.929966
    pairs += [(f"zyx{a}", f"zyx{b}") for a, b in [(stem + "ghijklmno", stem + "ghijkl" + "0123456789")]]  # 32 and 39 characters, 29 in common
    names = sorted({n for p in pairs for n in p})
    from ferrule.functions.columns import _jaro_winkler

    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if int(_jaro_winkler(a, b) * 10000 + 0.5) / 10000 >= 0.93}
    assert any(_jaro_winkler(a, b) < 0.93 for a, b in want)
    got = {(r.a, r.b): r.score for r in resolver.similar_names(spark.createDataFrame([(n,) for n in names], "n string"), "n", 0.93).collect()}
    assert set(got) == want and min(got.values()) == 0.93


def test_flags_are_pairs_of_companies(spark, tmp_path):
    """Companies that share a core name are flagged with each other and with all companies of a similar one."""
    from ferrule.functions.columns import _jaro_winkler
    from ferrule.plans import catalogue, resolution
    from ferrule.plans.base import Tables

    spark.range(60).select(F.col("id").alias("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    core = {r.id: r.name.removesuffix(" Games") for r in resolution.varied_names(Tables(spark, str(tmp_path))).collect()}
    score = lambda a, b: 0.95 if a == b else int(_jaro_winkler(*sorted((a, b))) * 10000 + 0.5) / 10000
    want = {(a, b, score(core[a], core[b])) for a in core for b in core if a < b and score(core[a], core[b]) >= 0.93}
    got = [tuple(r) for r in catalogue.QUERIES["fuzzy_flags"](spark, str(tmp_path)).select("id", "other", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {(0, 3), (1, 3)} <= {(a, b) for a, b, _ in want}  # the one name, and one of the second company of that name
