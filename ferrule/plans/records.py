"""Provider documents as records, and whole merges of games and companies. Each part is a game with up to three records."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions import columns as C
from ferrule.operators import merge
from ferrule.plans.base import query
from ferrule.sources import records


def key():
    return F.col("p_partkey")


def _some(every: int, value, rest: int = 0):
    return F.when(key() % every == rest, value)


def _choice(*values):
    """The value at p_partkey modulo the number of values."""
    return F.get(F.array(*(F.lit(v) for v in values)), (key() % len(values)).cast("int"))


def store_documents(t) -> DataFrame:
    """id and json of the store: every fiftieth is cut short, every third game isn't sold there."""
    release = F.struct((key() % 7 == 0).alias("coming_soon"), _choice("May 3, 2001", "3 May, 2001", "May 2001", "soon", "2001", None).alias("date"))
    json = F.to_json(F.struct(
        key().alias("steam_appid"), F.when(key() % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("name"), _choice("game", "dlc", "demo", "video").alias("type"),
        F.concat(F.lit("A &amp; <b>B</b><br>"), "p_type").alias("short_description"), F.lit("English<strong>*</strong>, French<br>with audio").alias("supported_languages"),
        _some(4, F.concat(F.lit("https://game.example/"), key().cast("string"))).alias("website"), F.concat(F.lit("https://img.example/"), key().cast("string"), F.lit(".jpg?t=1")).alias("header_image"),
        F.when(key() % 6 != 0, F.array(F.concat(F.lit("Studio "), (key() % 7).cast("string"), F.lit(" ")), F.lit(" "))).alias("developers"), F.array(F.lit("House")).alias("publishers"),
        F.array(F.struct(F.when(key() % 5 == 1, "70").otherwise("1").alias("id"), F.col("p_type").alias("description")), F.struct(F.lit("23").alias("id"), F.lit("Indie").alias("description"))).alias("genres"),
        F.array(F.struct(F.lit("Full Controller").alias("description"))).alias("categories"),
        F.struct((key() % 2 == 0).alias("windows"), (key() % 3 == 1).alias("mac"), F.lit(False).alias("linux")).alias("platforms"), release.alias("release_date"),
        _some(10, F.struct((key() - 1).alias("appid")), 1).alias("fullgame"), _some(10, F.array(key() + 1)).alias("dlc"), F.struct((key() * 3).alias("total"), key().alias("positive")).alias("reviews"),
    ))
    return t.part.where(key() % 3 != 0).select(key().alias("id"), F.when(key() % 50 == 0, F.substring(json, 1, 30)).otherwise(json).alias("json"))


STORE_SQL = """store AS (SELECT p_partkey AS id, 1 AS ordinal, 'steam' AS provider, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS title, []::VARCHAR[] AS alternates,
  (['game', 'dlc', 'demo', 'other'])[1 + p_partkey % 4] AS type, (['2001-05-03', '2001-05-03', '2001-05', NULL, '2001', NULL])[1 + p_partkey % 6] AS release_date,
  CASE WHEN p_partkey % 7 = 0 THEN 'upcoming' WHEN p_partkey % 5 = 1 THEN 'early-access' WHEN p_partkey % 6 IN (3, 5) THEN 'unknown' ELSE 'released' END AS status,
  CASE WHEN p_partkey % 6 <> 0 THEN ['Studio ' || (p_partkey % 7)] ELSE [] END AS developers, ['House'] AS publishers, ['genre-' || lower(p_type), 'indie'] AS genres, []::VARCHAR[] AS tags,
  ['full-controller'] AS features, list_filter([CASE WHEN p_partkey % 2 = 0 THEN 'windows' END, CASE WHEN p_partkey % 3 = 1 THEN 'macos' END], lambda x: x IS NOT NULL) AS platforms, ['English', 'French'] AS languages,
  p_partkey::VARCHAR AS steam, CASE WHEN p_partkey % 4 = 0 THEN 'https://game.example/' || p_partkey END AS website, NULL::VARCHAR AS franchise,
  CASE WHEN p_partkey % 10 = 1 THEN 'steam:' || (p_partkey - 1) END AS parent, CASE WHEN p_partkey % 10 = 0 THEN [(p_partkey + 1)::VARCHAR] ELSE [] END AS dlc, p_partkey * 3 AS review_count,
  'https://store.example/app/' || p_partkey || '/' AS url, NULL::VARCHAR AS link, []::VARCHAR[] AS engines FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 50 <> 0)""".replace("'genre-' || lower(p_type)", "lower(p_type)")


def joined(column, by: str = "|"):
    return F.array_join(column, by)


@query("store_records", f"WITH {STORE_SQL} SELECT id, title, type, release_date, status, array_to_string(developers, '|') AS developers, array_to_string(list_distinct(genres), '|') AS genres, array_to_string(features, '|') AS features, array_to_string(platforms, '|') AS platforms, array_to_string(languages, '|') AS languages, website, parent, array_to_string(dlc, '|') AS dlc, review_count FROM store".replace("array_to_string(list_distinct(genres), '|')", "array_to_string(genres, '|')"))
def store_records(t):
    r = records.store_records(store_documents(t), "json", ["id"])
    f = "record."
    return r.select("id", f + "title", f + "type", f + "release_date", F.col(f + "release_status").alias("status"), *(joined(f + c).alias(c) for c in ("developers", "genres", "features", "platforms", "languages")), f + "website", F.concat_ws(":", f + "parent.provider", f + "parent.id").alias("p"), joined(f + "dlc").alias("dlc"), f + "review_count").withColumn("parent", F.nullif("p", F.lit(""))).drop("p")


@query("store_policies", "SELECT p_partkey AS id, policy, CASE WHEN policy = 'everything' THEN 'A & B ' || p_type END AS description, CASE WHEN policy = 'everything' THEN 'https://img.example/' || p_partkey || '.jpg' END AS header FROM part, (VALUES ('metadata only'), ('everything')) AS v(policy) WHERE p_partkey % 3 <> 0 AND p_partkey % 50 <> 0")
def store_policies(t):
    each = (records.store_records(store_documents(t), "json", ["id"], on, on).select("id", F.lit("everything" if on else "metadata only").alias("policy"), "record.description", "record.header") for on in (False, True))
    return functools.reduce(DataFrame.unionByName, each)


def database_documents(t) -> DataFrame:
    company = lambda name, **flags: F.struct(*(F.lit(flags.get(f, False)).alias(f) for f in ("developer", "publisher", "porting", "supporting")), F.struct(name.alias("name"), F.lit("s").alias("slug")).alias("company"))
    json = F.to_json(F.struct(
        F.concat(F.lit("g-"), key().cast("string")).alias("slug"), _some(4, F.lit(None).cast("string")).otherwise(F.upper("p_name")).alias("name"),
        F.array(F.struct(F.concat("p_name", F.lit(" Deluxe")).alias("name")), F.struct(F.lit("An Alias").alias("name"))).alias("alternative_names"),
        F.struct(_choice("Main Game", "DLC Addon", "Remake", "Mod", "Port").alias("type")).alias("game_type"), F.when(key() % 3 != 1, key() * 86400).alias("first_release_date"),
        F.array(company(F.concat(F.lit("Studio "), (key() % 5).cast("string")), developer=True), company(F.lit("House"), publisher=True, developer=False), company(F.lit("Helpers"), supporting=True)).alias("involved_companies"),
        F.array(F.struct(F.lit("Mac OS X").alias("name")), F.struct(F.lit("PC").alias("name"))).alias("platforms"), F.array(F.struct(F.col("p_brand").alias("name")), F.struct(F.lit("Role-playing (RPG)").alias("name"))).alias("genres"),
        F.array(F.struct(F.lit("Open World").alias("name"))).alias("themes"), _some(2, F.array(F.struct(F.lit("Engine X").alias("name")))).alias("game_engines"),
        _some(6, F.struct(F.lit("The Saga").alias("name"))).alias("franchise"),
        F.array(F.struct(F.lit(5).alias("external_game_source"), F.lit("other").alias("uid")), F.struct(F.lit(1).alias("external_game_source"), F.when(key() % 2 == 0, key().cast("string")).otherwise("").alias("uid"))).alias("external_games"),
    ))
    return t.part.select(key().alias("id"), json.alias("json"))


DATABASE_SQL = """base AS (SELECT p_partkey AS id, 2 AS ordinal, 'igdb' AS provider, CASE WHEN p_partkey % 4 <> 0 THEN upper(p_name) END AS title, CASE WHEN p_name || ' Deluxe' < 'An Alias' THEN [p_name || ' Deluxe', 'An Alias'] ELSE ['An Alias', p_name || ' Deluxe'] END AS alternates,
  (['game', 'dlc', 'remake', 'game', 'port'])[1 + p_partkey % 5] AS type, CASE WHEN p_partkey % 3 <> 1 AND p_partkey <> 0 THEN strftime(make_timestamp(p_partkey * 86400 * 1000000), '%Y-%m-%d') END AS release_date, NULL::VARCHAR AS status,
  ['Studio ' || (p_partkey % 5)] AS developers, ['House'] AS publishers, [replace(lower(p_brand), '#', '-'), 'rpg'] AS genres, ['open-world'] AS tags, []::VARCHAR[] AS features, ['macos', 'windows'] AS platforms, []::VARCHAR[] AS languages,
  CASE WHEN p_partkey % 2 = 0 THEN p_partkey::VARCHAR END AS steam, NULL::VARCHAR AS website, CASE WHEN p_partkey % 6 = 0 THEN 'The Saga' END AS franchise, NULL::VARCHAR AS parent, []::VARCHAR[] AS dlc, NULL::BIGINT AS review_count,
  'https://database.example/games/g-' || p_partkey AS url, 'igdb=https://database.example/games/g-' || p_partkey AS link, CASE WHEN p_partkey % 2 = 0 THEN ['engine-x'] ELSE [] END AS engines FROM part)"""


@query("database_records", f"WITH {DATABASE_SQL} SELECT id, title, array_to_string(alternates, '|') AS alternates, type, release_date, array_to_string(developers, '|') AS developers, array_to_string(publishers, '|') AS publishers, array_to_string(genres, '|') AS genres, array_to_string(tags, '|') AS tags, array_to_string(platforms, '|') AS platforms, steam, franchise, array_to_string(engines, '|') AS engines, url FROM base")
def database_records(t):
    r = records.database_records(database_documents(t), "json", ["id"])
    f = "record."
    engines = F.transform(F.col("record.technology"), lambda x: C.slug(x["name"]))
    return r.select("id", f + "title", joined(f + "alternate_titles").alias("alternates"), f + "type", f + "release_date", *(joined(f + c).alias(c) for c in ("developers", "publishers", "genres", "tags", "platforms")), f + "steam", f + "franchise", joined(engines).alias("engines"), f + "url")


def encyclopedia_records(t) -> DataFrame:
    """id and record of the third provider, for every other game."""
    return records._record(
        t.part.where(key() % 2 == 0), [key().alias("id")], provider=F.lit("wikidata"), wikidata=F.concat(F.lit("Q"), key().cast("string")), steam=_some(4, key().cast("string")), url=F.concat(F.lit("https://items.example/Q"), key().cast("string")),
        title=F.concat("p_name", F.lit(" (game)")), release_date=F.lit("2001-05-03"), developers=F.array(F.concat(F.lit("Studio "), (key() % 7).cast("string")), F.lit("Studio 9")), genres=F.array(F.lit("Platform Game"), F.lit("Early Access")),
        platforms=F.array(F.lit("Nintendo Switch")), website=F.concat(F.lit("https://site.example/"), key().cast("string")), links=F.create_map(F.lit("official"), F.lit("https://old.example/"), F.lit("igdb"), F.lit("https://late.example/")),
        technology=F.array(F.struct(F.lit("Engine X").alias("name"), F.lit("engine").alias("role"))), franchise=F.lit("A Saga"),
    )


ITEMS_SQL = """items AS (SELECT p_partkey AS id, 3 AS ordinal, 'wikidata' AS provider, p_name || ' (game)' AS title, []::VARCHAR[] AS alternates, NULL::VARCHAR AS type, '2001-05-03' AS release_date, NULL::VARCHAR AS status,
  ['Studio ' || (p_partkey % 7), 'Studio 9'] AS developers, []::VARCHAR[] AS publishers, ['platformer', 'early-access'] AS genres, []::VARCHAR[] AS tags, []::VARCHAR[] AS features, ['nintendo-switch'] AS platforms, []::VARCHAR[] AS languages,
  CASE WHEN p_partkey % 4 = 0 THEN p_partkey::VARCHAR END AS steam, 'https://site.example/' || p_partkey AS website, 'A Saga' AS franchise, NULL::VARCHAR AS parent, []::VARCHAR[] AS dlc, NULL::BIGINT AS review_count,
  'https://items.example/Q' || p_partkey AS url, 'official=https://old.example/' AS link, ['engine-x'] AS engines FROM part WHERE p_partkey % 2 = 0)"""
RECORDS_SQL = f"{STORE_SQL}, {DATABASE_SQL}, {ITEMS_SQL}, r AS (SELECT * FROM store UNION ALL SELECT * FROM base UNION ALL SELECT * FROM items)"


def all_records(t) -> DataFrame:
    store, base, items = records.store_records(store_documents(t), "json", ["id"]), records.database_records(database_documents(t), "json", ["id"]), encyclopedia_records(t)
    every = functools.reduce(DataFrame.unionByName, (x.withColumn("ordinal", F.lit(i)) for i, x in enumerate((store, base, items), 1)))
    return every.withColumnRenamed("id", "cluster")


def _picked_sql(name: str, order: tuple[str, ...], blank: str) -> str:
    rank = "CASE provider " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(order)) + " END"
    return f"x_{name} AS (SELECT id, first({name} ORDER BY {rank}) AS {name}, first(provider ORDER BY {rank}) AS {name}_from FROM r WHERE NOT ({blank}) AND {rank} IS NOT NULL GROUP BY 1)"


_PICKS = {n: _picked_sql(n, merge.PICKED[n], f"coalesce({n}, '') = ''") for n in ("title", "type", "release_date", "franchise", "website", "parent")}
_PICKS |= {n: _picked_sql(n, merge.PICKED[n], f"len({n}) = 0") for n in ("developers", "publishers", "features", "languages")}
_UNION = "array_to_string(list_sort(list_distinct(flatten(list({0})))), '|') AS {0}"
_LINKS = """list_sort(list_filter([CASE WHEN x_website.website IS NOT NULL THEN 'official=' || x_website.website END, CASE WHEN true THEN 'igdb=https://database.example/games/g-' || a.id END], lambda x: x IS NOT NULL))"""


@query(
    "full_game_merge",
    f"""WITH {RECORDS_SQL}, {", ".join(_PICKS.values())},
    a AS (SELECT id, array_to_string(list_sort(list_distinct(list_filter(flatten(list(genres)), lambda g: g NOT IN ('indie', 'early-access')))), '|') AS genres, {_UNION.format("tags")}, {_UNION.format("platforms")}, {_UNION.format("dlc")},
      list_distinct(flatten(list(list_append(alternates, coalesce(title, ''))))) AS titles, max(review_count) AS review_count, max(status) AS status, list(release_date) AS dates, min(steam::BIGINT)::VARCHAR AS steam,
      array_to_string(list_sort(list(provider)), '|') AS sources, count(*) FILTER (len(engines) > 0) AS engine_votes FROM r GROUP BY 1),
    d AS (SELECT a.id, x_release_date.release_date AS picked, list_sort(list_filter(dates, lambda x: starts_with(x, x_release_date.release_date) AND length(x) > length(x_release_date.release_date)), 'DESC') AS finer FROM a LEFT JOIN x_release_date USING (id))
    SELECT a.id, coalesce(x_title.title, a.id::VARCHAR) AS title, array_to_string(list_sort(list_filter(titles, lambda t: t <> '' AND t <> coalesce(x_title.title, a.id::VARCHAR))), '|') AS alternate_titles, coalesce(x_type.type, 'game') AS type,
      CASE WHEN length(picked) < 10 AND len(finer) > 0 THEN finer[1] ELSE picked END AS release_date, CASE WHEN a.status IS NOT NULL THEN a.status WHEN picked IS NULL THEN 'unknown' WHEN (CASE WHEN length(picked) < 10 AND len(finer) > 0 THEN finer[1] ELSE picked END) <= '1990-06-15' THEN 'released' ELSE 'upcoming' END AS release_status,
      array_to_string(list_sort(coalesce(developers, [])), '|') AS developers, array_to_string(list_sort(coalesce(publishers, [])), '|') AS publishers, genres, tags, array_to_string(coalesce(features, []), '|') AS features, platforms, array_to_string(coalesce(languages, []), '|') AS languages,
      a.steam, 'g-' || a.id AS igdb, CASE WHEN a.id % 2 = 0 THEN 'Q' || a.id END AS wikidata, array_to_string({_LINKS}, '|') AS links, CASE engine_votes WHEN 0 THEN '' WHEN 1 THEN 'engine:engine-x:medium' ELSE 'engine:engine-x:high' END AS technology,
      CASE WHEN franchise IS NOT NULL THEN replace(lower(franchise), ' ', '-') END AS franchise, parent, dlc, review_count, sources, coalesce(title_from, '') || '/' || coalesce(developers_from, '') || '/' || coalesce(release_date_from, '') AS provenance
    FROM a JOIN d USING (id) {" ".join(f"LEFT JOIN x_{n} ON x_{n}.id = a.id" for n in _PICKS)}""",
)
def full_game_merge(t):
    m = merge.dated_status(merge.merge_games(all_records(t)), "1990-06-15")
    source = lambda f: F.coalesce(F.get(F.filter("provenance", lambda p: p["field"] == f), 0)["provider"], F.lit(""))
    entries = F.transform(F.map_entries("links"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return m.select(
        F.col("cluster").alias("id"), "title", joined("alternate_titles").alias("alternate_titles"), "type", "release_date", "release_status",
        *(joined(c).alias(c) for c in ("developers", "publishers", "genres", "tags", "features", "platforms", "languages")), "steam", "igdb", "wikidata", joined(F.array_sort(entries)).alias("links"),
        joined(F.transform("technology", lambda x: F.concat_ws(":", x["role"], x["id"], x["confidence"]))).alias("technology"), F.col("franchise.id").alias("franchise"), F.when(F.col("parent").isNotNull(), F.concat_ws(":", "parent.provider", "parent.id")).alias("parent"),
        joined("dlc").alias("dlc"), "review_count", joined(F.transform("sources", lambda s: s["provider"])).alias("sources"), F.concat_ws("/", source("title"), source("developers"), source("release_date")).alias("provenance"),
    )


@query(
    "game_relations",
    """WITH e AS (SELECT p_partkey - 1 AS game, p_partkey AS part FROM part WHERE p_partkey % 10 = 1 AND p_partkey % 3 <> 0 UNION SELECT p_partkey, p_partkey + 1 FROM part WHERE p_partkey % 10 = 0 AND p_partkey % 3 <> 0 AND p_partkey % 50 <> 0),
    known AS (SELECT p_partkey AS id FROM part WHERE (p_partkey % 3 <> 0 AND p_partkey % 50 <> 0) OR p_partkey % 2 = 0), k AS (SELECT * FROM e WHERE game IN (SELECT id FROM known) AND part IN (SELECT id FROM known))
    SELECT p_partkey AS id, (SELECT min(game) FROM k WHERE part = p_partkey) AS parent_game, coalesce((SELECT string_agg(part::VARCHAR, '|' ORDER BY part) FROM k WHERE game = p_partkey), '') AS dlc FROM part""",
)
def game_relations(t):
    every = all_records(t)
    ids = every.where("record.steam is not null").groupBy(F.lit("steam").alias("provider"), F.col("record.steam").alias("id")).agg(F.min("cluster").alias("cluster"))
    found = merge.known_relations(merge.merge_games(every), ids)
    return found.select(F.col("cluster").alias("id"), "parent_game", joined(F.transform("dlc", lambda x: x.cast("string"))).alias("dlc"))


@query(
    "full_company_merge",
    """WITH r AS (SELECT s_suppkey AS id, 1 AS ordinal, CASE WHEN s_suppkey % 4 = 0 THEN s_name WHEN s_suppkey % 4 = 1 THEN '' END AS name, CASE WHEN s_suppkey % 6 = 0 THEN s_nationkey END AS parent, s_suppkey % 5 = 0 AS dissolved, CASE WHEN s_suppkey % 2 = 0 THEN 'Q' || s_suppkey END AS ids FROM supplier WHERE s_suppkey % 7 <> 0),
    n AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 7 <> 0 OR s_suppkey % 3 = 0 OR s_suppkey % 2 = 1 OR s_suppkey % 11 = 0)
    SELECT n.id, coalesce(nullif(r.name, ''), CASE WHEN n.id % 3 = 0 THEN 'Seed ' || n.id END, CASE WHEN n.id % 2 = 1 THEN 'Prior ' || n.id END, CASE WHEN n.id % 11 = 0 THEN 'New ' || n.id END, n.id::VARCHAR) AS name,
      CASE WHEN r.parent IS NOT NULL THEN 'subsidiary' WHEN coalesce(r.dissolved, false) THEN 'defunct' ELSE 'independent' END AS status, r.parent, coalesce(r.ids, CASE WHEN n.id % 11 = 0 THEN 'new' END, CASE WHEN n.id % 2 = 1 THEN 'P' || n.id END) AS ids FROM n LEFT JOIN r USING (id)""",
)
def full_company_merge(t):
    k, text = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    r = t.supplier.where(k % 7 != 0).select(k.alias("id"), F.lit(1).alias("ordinal"), F.when(k % 4 == 0, F.col("s_name")).when(k % 4 == 1, "").alias("name"), F.when(k % 6 == 0, F.col("s_nationkey")).alias("parent"), (k % 5 == 0).alias("dissolved"), F.when(k % 2 == 0, F.concat(F.lit("Q"), text)).alias("ids"))
    again = r.where("id % 4 = 0").withColumns({"ordinal": F.lit(2), "name": F.lit("later")})  # a later record changes nothing that an earlier one says
    seeds = t.supplier.where(k % 3 == 0).select(k.alias("id"), F.concat(F.lit("Seed "), text).alias("name"))
    prior = t.supplier.where(k % 2 == 1).select(k.alias("id"), F.concat(F.lit("Prior "), text).alias("name"), F.concat(F.lit("P"), text).alias("ids"))
    created = t.supplier.where(k % 11 == 0).select(k.alias("id"), F.concat(F.lit("New "), text).alias("name"), F.lit("new").alias("ids"))
    return merge.merge_companies(r.unionByName(again), seeds, prior, created)
