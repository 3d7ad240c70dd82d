"""References that teach each other, against a plain version; ids that stay over builds."""

import random

import pytest
from test_ladder import PROVIDERS, exact, loose, plain

from ferrule import engine
from ferrule.functions import columns as C
from ferrule.operators import resolver

REFS = "ref long, name string, steam string, wikidata string, igdb string"
ENTRIES = "id string, name string, aliases array<string>, seeded boolean, steam string, wikidata string, igdb string"


def keys_of(ref):
    compact = loose(ref["name"]).replace(" ", "")
    return {("exact", exact(ref["name"])), ("loose", loose(ref["name"])), ("compact", compact if len(compact) >= 5 else "")} | {(p, ref[p] or "") for p in PROVIDERS}


def one_after_another(refs, entries):
    """The same rounds with lists: everybody open is asked in every round."""
    entries, open_, out, taken = [dict(e) for e in entries], sorted(refs, key=lambda r: r["ref"]), {}, {e["id"] for e in entries}
    while open_:
        found = {r["ref"]: plain(r, entries, {}, {}, {}, [])[0] for r in open_}
        found = {r: i for r, i in found.items() if i is not None}
        created = not found
        if created:
            known = [(k, r["ref"]) for r in open_ for k in keys_of(r) if k[1]]
            first = [r for r in open_ if all(min(x for key, x in known if key == k) == r["ref"] for k in keys_of(r) if k[1])]
            for r in first:
                slug = r["name"].lower().replace(".", "").replace(" ", "-")
                name, n = slug, 2
                while name in taken:
                    name, n = f"{slug}-{n}", n + 1
                taken.add(name)
                found[r["ref"]] = name
        for r in open_:
            if r["ref"] not in found:
                continue
            own = next((e for e in entries if e["id"] == found[r["ref"]]), None)
            if own is None:
                entries.append(own := {"id": found[r["ref"]], "name": r["name"], "aliases": [], "seeded": False} | dict.fromkeys(PROVIDERS))
            own["aliases"] = sorted({*own["aliases"], r["name"]} - {own["name"]})
            for p in PROVIDERS:
                own[p] = own[p] or r[p]
            out[r["ref"]] = (found[r["ref"]], created)
        open_ = [r for r in open_ if r["ref"] not in found]
    return out


def resolved(spark, refs, entries, parts):
    none = lambda shape: spark.createDataFrame([], shape)
    found, known = resolver.resolve_all(spark.createDataFrame(refs, REFS).repartition(parts), spark.createDataFrame(entries, ENTRIES), none("key string, id string"), none("name string, id string"), none("key string, id string"), none("a string, b string"))
    rows = known.collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.ref: (r.id, r.created) for r in found.collect()}, max(r.round for r in found.collect())


def test_long_chain(spark):
    """Eight references in a row, each known by one thing of the one before, greater refs first."""
    chain = [("Alpha", "1", None, None), ("Beta", "1", "2", None), ("Gamma", None, "2", "3"), ("Delta", None, None, "3"), ("Delta", None, None, None), ("Alpha Inc.", None, None, None), ("Omega", None, None, "9"), ("Omega Games", None, None, "8")]
    refs = [{"ref": 100 - i, "name": n, "steam": s, "wikidata": w, "igdb": g} for i, (n, s, w, g) in enumerate(chain)]
    got, rounds = resolved(spark, refs, [{"id": "alpha", "name": "Alpha Inc", "aliases": None, "seeded": True, "steam": None, "wikidata": None, "igdb": None}], 3)
    assert {got[100 - i] for i in range(6)} == {("alpha", False)} and rounds >= 5
    assert got[93] == ("omega-games", True) and got[94] == ("omega", True)  # their ids differ, so that they are two


@pytest.mark.parametrize("seed", range(1))
def test_equal_to_plain_rounds(spark, seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("alder birch cedar delta ember".split())
    name = lambda: " ".join(x for x in (word().title(), rnd.choice(["", word().title()]), rnd.choice(["", "", "Games", "Inc."])) if x)
    some = lambda: rnd.choice([None, None, f"x{rnd.randint(1, 12)}"])
    entries = [{"id": f"e{i}", "name": name(), "aliases": [], "seeded": rnd.random() < 0.3, **{p: some() for p in PROVIDERS}} for i in range(4)]
    refs = [{"ref": i, "name": name(), **{p: some() for p in PROVIDERS}} for i in range(30)]
    rnd.shuffle(refs)
    got, _ = resolved(spark, refs, entries, 5)
    assert got == one_after_another(refs, entries)


def record(spark, rows):
    """Records (ordinal, provider, id, title, date, developers) of games."""
    from ferrule.sources import records

    shape = spark.createDataFrame([], records.RECORD).schema
    full = [{f.name: None for f in shape} | {"provider": p, p: i, "title": t, "release_date": d, "developers": devs} for _, p, i, t, d, devs in rows]
    return spark.createDataFrame([(r[0], f) for r, f in zip(rows, full, strict=True)], f"ordinal int, record struct<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in shape)}>")


def test_ids_stay_over_builds(spark):
    """Two games of one title get two ids; a new title, and a new provider id that sorts first, leave them."""
    seeds = spark.createDataFrame([("studio", "Studio", None, None, None, None)], "id string, name string, aliases array<string>, steam string, wikidata string, igdb string")
    rows = [(1, "steam", "20", "Doom", "1993-12-10", ["Studio"]), (2, "steam", "30", "Doom", "2016-05-13", ["Studio"]), (3, "steam", "40", "Doom", None, ["Studio"])]
    first = engine.build({"records": record(spark, rows), "seeds": seeds}, "2026-01-16")
    ids = {g.steam: g.id for g in first["games"].collect()}
    assert ids == {"20": "doom", "30": "doom-2016", "40": "doom-2"}
    rows = [(0, "steam", "10", "Doom", "1992-01-01", ["Studio"]), (1, "steam", "20", "Doom Classic", "1993-12-10", ["Studio"]), *rows[1:]]
    again = {"records": record(spark, rows), "seeds": seeds, "game_registry": first["game_registry"], "registry": first["registry"], "previous_games": first["games"].select("id")}
    after = engine.build(again, "2026-01-16")
    assert {g.steam: g.id for g in after["games"].collect()} == ids | {"10": "doom-1992"}
    found = {(c.category, c.subject) for c in engine.report(first, after, seeds).collect()}
    assert found == {("new-game", "doom-1992")}


def test_registered_games_that_become_one(spark):
    seeds = spark.createDataFrame([("studio", "Studio", None, "77", None, None)], "id string, name string, aliases array<string>, steam string, wikidata string, igdb string")
    registry = spark.createDataFrame([("steam:1", "one"), ("igdb:a", "another")], "key string, id string")
    both = record(spark, [(1, "steam", "1", "One", None, ["Makers"]), (2, "igdb", "a", "One", None, ["Makers"])])
    linked = both.withColumn("record", C.F.when(C.F.col("ordinal") == 2, C.F.col("record").withField("steam", C.F.lit("1"))).otherwise(C.F.col("record")))
    company = spark.createDataFrame([("Makers", "77", None, None)], "name string, steam string, wikidata string, igdb string")
    built = engine.build({"records": linked, "seeds": seeds, "game_registry": registry, "company_ids": company}, "2026-01-16")
    assert [g.id for g in built["games"].collect()] == ["one"]
    assert [(i.kind, i.subject, i.details) for i in built["issues"].collect()] == [("potential-duplicate", "one", "another")]
    assert {c.id for c in built["companies"].collect()} == {"studio"}  # by the provider's id, as the names differ
