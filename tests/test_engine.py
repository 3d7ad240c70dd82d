"""From provider documents and curated files to a build, its published folder and what changed."""

import json

import pytest

from ferrule import engine
from ferrule.sources import curated, layout, records

STORE = [
    {"steam_appid": 990001, "name": "Lantern Road", "type": "game", "developers": ["Hollow Lantern Studio"], "publishers": ["Paper Moon"], "genres": [{"id": "1", "description": "Platform"}, {"id": "23", "description": "Indie"}],
     "platforms": {"windows": True, "mac": False, "linux": False}, "release_date": {"coming_soon": False, "date": "12 Mar, 2021"}, "reviews": {"total": 12840, "positive": 12000}, "dlc": [990002]},
    {"steam_appid": 990002, "name": "Lantern Road: Ashes", "type": "dlc", "developers": ["Hollow Lantern Studio"], "publishers": ["Paper Moon"], "fullgame": {"appid": 990001}, "release_date": {"coming_soon": True, "date": "soon"}},
    {"steam_appid": 990009, "name": "Somebody Else", "type": "game", "developers": ["Nobody Known"], "publishers": []},
]
DATABASE = [
    {"slug": "lantern-road", "name": "Lantern Road", "game_type": {"type": "Main Game"}, "first_release_date": 1615507200, "involved_companies": [{"developer": True, "publisher": False, "porting": False, "supporting": False, "company": {"name": "The Hollow Lantern Studios", "slug": "hl"}}],
     "platforms": [{"name": "Mac"}, {"name": "Nintendo Switch"}], "game_engines": [{"name": "Ember Engine"}], "external_games": [{"external_game_source": 1, "uid": "990001"}]},
]
SEEDS = """
- id: hollow-lantern
  name: Hollow Lantern
  aliases: [Hollow Lantern Studio]
  externalIds: {wikidata: Q900101}
- id: quiet-harbor
  name: Quiet Harbor
  roles: [developer]
  discover: false
"""


@pytest.fixture()
def given(spark, tmp_path):
    (tmp_path / "seeds").mkdir()
    (tmp_path / "seeds" / "companies.yaml").write_text(SEEDS)
    found = curated.load_curated(spark, str(tmp_path))
    text = lambda rows: spark.createDataFrame([(json.dumps(r),) for r in rows] + [("{not json",)], "json string")
    store, base = records.store_records(text(STORE), "json", []), records.database_records(text(DATABASE), "json", [])
    every = store.selectExpr("1 as ordinal", "record").unionByName(base.selectExpr("2 as ordinal", "record"))
    seeds = found["seeds/companies"].selectExpr("id", "name", "aliases", "externalIds['steam'] as steam", "externalIds['wikidata'] as wikidata", "externalIds['igdb'] as igdb")
    return {"records": every, "seeds": seeds}


def test_build(given):
    built = engine.build(given, "2026-01-16")
    games = {g.id: g for g in built["games"].collect()}
    assert set(games) == {"lantern-road", "lantern-road-ashes"}
    main = games["lantern-road"]
    assert (main.steam, main.igdb, main.release_date, main.release_status, main.review_count) == ("990001", "lantern-road", "2021-03-12", "released", 12840)
    assert main.platforms == ["macos", "nintendo-switch", "windows"] and main.genres == ["platformer"]
    assert [p for p in main.provenance if p.field == "developers"][0].alternatives == ['["The Hollow Lantern Studios"]']
    assert {c.id for c in built["companies"].collect()} == {"hollow-lantern", "quiet-harbor", "paper-moon"}
    edges = {e.id for e in built["edges"].collect()}
    assert {"hollow-lantern:developer:lantern-road", "paper-moon:publisher:lantern-road", "lantern-road:uses-engine:ember-engine", "lantern-road-ashes:dlc-of:lantern-road"} <= edges
    again = engine.build(given, "2026-01-16")
    assert edges == {e.id for e in again["edges"].collect()}


def test_manual_edges_exclusion_and_report(spark, given):
    before = engine.build(given, "2026-01-16")
    manual = spark.createDataFrame([("paper-moon", "publisher", "lantern-road", True), ("quiet-harbor", "porting", "lantern-road", False)], "from string, type string, to string, remove boolean")
    after = engine.build(given | {"relationships": manual}, "2026-01-16")
    edges = {e.id for e in after["edges"].collect()}
    assert "quiet-harbor:porting:lantern-road" in edges and "paper-moon:publisher:lantern-road" not in edges
    found = {(c.category, c.subject) for c in engine.report(before, after, given["seeds"]).collect()}
    assert found == {("relationship-change", "paper-moon")}
    without = engine.build(given | {"excluded": spark.createDataFrame([("hollow-lantern",)], "id string")}, "2026-01-16")
    assert without["games"].count() == 0 and {c.id for c in without["companies"].collect()} == {"quiet-harbor"}


def test_curated_files(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("﻿- id: a\n  aliases: [x, 2]\n  externalIds: {steam: 5}\n- id: b\n")
    got = curated.read_yaml(spark, str(tmp_path / "a.yaml"), curated.CURATED["seeds/companies"]).collect()
    assert [(r.id, r.aliases, r.externalIds, r.discover) for r in got] == [("a", ["x", "2"], {"steam": "5"}, True), ("b", [], None, True)]
    assert curated.read_yaml(spark, str(tmp_path / "none.yaml"), "id string").count() == 0
    (tmp_path / "b.yaml").write_text("- id: [1]\n  colour: red\n- plain\n- aliases: x\n")
    with pytest.raises(curated.ShapeError) as error:
        curated.read_yaml(spark, str(tmp_path / "b.yaml"), "id string, aliases array<string>")
    assert error.value.paths == ["[0].colour: unknown field", "[0].id: not a string", "[1]: not an object", "[2].aliases: not a list"]


def test_published_folder(spark, tmp_path):
    root = str(tmp_path / "out")
    games = spark.createDataFrame([("a", "A", "x"), ("b", "B", None), ("c", "C", "x")], "id string, title string, studio string")
    files = layout.documents({"games": (games, None), "entities/games": (games, "id"), "by-studio": (games.where("studio is not null"), "studio")})
    actions = lambda df: sorted((r.path, r.action) for r in df.collect())
    first = actions(layout.sync(files, root))
    assert first == [(p, "write") for p in ("by-studio/x.json", "entities/games/a.json", "entities/games/b.json", "entities/games/c.json", "games.json")]
    assert json.loads((tmp_path / "out" / "by-studio" / "x.json").read_text()) == [{"id": "a", "title": "A", "studio": "x"}, {"id": "c", "title": "C", "studio": "x"}]
    assert actions(layout.sync(files, root)) == []
    fewer = games.where("id <> 'c'").withColumn("title", games.title)
    files = layout.documents({"games": (fewer, None), "entities/games": (fewer, "id")})
    assert actions(layout.sync(files, root)) == [("by-studio/x.json", "delete"), ("entities/games/c.json", "delete"), ("games.json", "write")]
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*.json")) == ["entities/games/a.json", "entities/games/b.json", "games.json"]


def test_finish(spark, given):
    first = engine.finish(engine.build(given, "2026-01-16"), "2026-01-16")
    assert first["problems"].collect() == []
    stats = {r.company: r for r in first["company_statistics"].collect()}
    own = stats["hollow-lantern"]
    assert (own.game_count, own.developed_count, own.published_count, own.total_reviews, own.average_positive, own.weighted_positive) == (2, 2, 0, 12840, 93.5, 93.5)
    assert (own.most_reviewed, own.first_release, own.latest_release, own.technology_count, own.engines) == ("lantern-road", "lantern-road", "lantern-road", 1, ["ember-engine"])
    none = stats["quiet-harbor"]
    assert (none.game_count, none.total_reviews, none.average_positive, none.most_reviewed, none.engines) == (0, 0, None, None, [])

    # reviews move from day to day and don't count; a title does
    moved = first["games"].drop("content_hash", "last_updated").selectExpr("* except (review_count, title)", "review_count + 5 as review_count", "if(id = 'lantern-road', title, 'Ashes') as title")
    ghost = first["edges"].drop("from_type", "to_type").unionByName(spark.createDataFrame([("x", "ghost", "developer", "lantern-road"), ("y", "lantern-road", "uses-engine", "paper-moon")], "id string, from string, type string, to string"))
    later = engine.finish({"games": moved, "companies": first["companies"].union(first["companies"].where("id = 'paper-moon'").selectExpr("'moon-2'", "'Paper Moon'", "* except (id, name)")), "edges": ghost}, "2026-02-01", first)
    assert {g.id: g.last_updated for g in later["games"].collect()} == {"lantern-road": "2026-01-16", "lantern-road-ashes": "2026-02-01"}
    assert {c.id: c.last_updated for c in later["companies"].collect()} == {"hollow-lantern": "2026-01-16", "quiet-harbor": "2026-01-16", "paper-moon": "2026-01-16", "moon-2": "2026-02-01"}
    told = {(p.level, p.kind, p.id, p.path, p.message) for p in later["problems"].collect()}
    assert {t for t in told if t[0] == "error"} == {("error", "edge", "x", "from", "unknown company ghost"), ("error", "edge", "y", "to", "unknown technology paper-moon")}
    assert {t[2] for t in told if t[0] == "warning"} == {"paper-moon", "moon-2"}
