"""Provider documents (nested JSON text) as records of one shape: RECORD. Malformed documents give no record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions import columns as C

#: One record of a game as a provider reports it.
RECORD = (
    "provider string, steam string, wikidata string, igdb string, url string, title string, alternate_titles array<string>, type string, "
    "release_date string, release_status string, developers array<string>, publishers array<string>, description string, "
    "genres array<string>, tags array<string>, features array<string>, platforms array<string>, languages array<string>, website string, "
    "links map<string,string>, header string, technology array<struct<name:string,role:string>>, franchise string, series string, "
    "parent struct<provider:string,id:string>, dlc array<string>, review_count bigint, positive_count bigint"
)
STORE = (
    "steam_appid bigint, name string, type string, short_description string, supported_languages string, website string, header_image string, "
    "developers array<string>, publishers array<string>, genres array<struct<id:string,description:string>>, categories array<struct<description:string>>, "
    "platforms struct<windows:boolean,mac:boolean,linux:boolean>, release_date struct<coming_soon:boolean,date:string>, "
    "fullgame struct<appid:bigint>, dlc array<bigint>, reviews struct<total:bigint,positive:bigint>"
)
DATABASE = (
    "slug string, name string, url string, alternative_names array<struct<name:string>>, game_type struct<type:string>, first_release_date bigint, "
    "involved_companies array<struct<developer:boolean,publisher:boolean,porting:boolean,supporting:boolean,company:struct<name:string,slug:string>>>, "
    "platforms array<struct<name:string>>, genres array<struct<name:string>>, themes array<struct<name:string>>, game_engines array<struct<name:string>>, "
    "franchise struct<name:string>, collections array<struct<name:string>>, parent_game struct<slug:string>, "
    "external_games array<struct<external_game_source:bigint,uid:string>>"
)
#: Types of the store; anything else is "other".
STORE_TYPES = {"game": "game", "dlc": "dlc", "demo": "demo"}
#: Types of the database; anything else is "game".
DATABASE_TYPES = {
    "main game": "game", "dlc addon": "dlc", "dlc": "dlc", "expansion": "expansion", "standalone expansion": "expansion",
    "remaster": "remaster", "remake": "remake", "port": "port", "bundle": "bundle",
}
#: The store's genre id of early access, and the database's number for the store.
EARLY_ACCESS, STEAM_SOURCE = "70", 1

_NONE = "cast(array() as array<string>)"


def _list(values: Column) -> Column:
    return F.coalesce(values, F.expr(_NONE))


def _record(rows: DataFrame, keep: list[str], **fields: Column) -> DataFrame:
    """rows with a struct `record` of RECORD's fields; fields that aren't named are null."""
    kinds = [f.split(" ", 1) for f in _split(RECORD)]
    return rows.select(*keep, F.struct(*(fields.get(n, F.lit(None)).cast(k).alias(n) for n, k in kinds)).alias("record"))


def _split(ddl: str) -> list[str]:
    """The fields of a DDL string; commas within brackets don't end one."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[at:i].strip())
            at = i + 1
    return [*out, ddl[at:].strip()]


def store_records(documents: DataFrame, json: str, keep: list[str], descriptions: bool = False, artwork: bool = False) -> DataFrame:
    """keep and record of the store's documents in the column json; the policies let descriptions and artwork through.

    A date counts whether the game is out or not. The status is upcoming, early access by the genre's id, released where
    there is a date, unknown otherwise.
    """
    rows = documents.withColumn("_d", F.from_json(json, STORE)).where("_d.steam_appid is not null")
    d = F.col("_d")
    date = C.store_date(d["release_date"]["date"])["date"]
    soon = F.coalesce(d["release_date"]["coming_soon"], F.lit(False))
    early = F.exists(F.coalesce(d["genres"], F.expr("cast(array() as array<struct<id:string,description:string>>)")), lambda g: g["id"] == EARLY_ACCESS)
    names = lambda c: F.filter(F.transform(_list(c), lambda x: F.trim(x)), lambda x: x != "")
    flags = (("windows", "windows"), ("mac", "macos"), ("linux", "linux"))
    short = C.html_text(F.coalesce(d["short_description"], F.lit("")))
    return _record(
        rows, keep,
        provider=F.lit("steam"), steam=d["steam_appid"].cast("string"), url=F.concat(F.lit("https://store.example/app/"), d["steam_appid"].cast("string"), F.lit("/")),
        title=F.trim(d["name"]), type=F.coalesce(C.map_literal(STORE_TYPES)[d["type"]], F.lit("other")), release_date=date,
        release_status=F.when(soon, "upcoming").when(early, "early-access").when(date.isNotNull(), "released").otherwise("unknown"),
        developers=names(d["developers"]), publishers=names(d["publishers"]), description=F.when(F.lit(descriptions) & (short != ""), short),
        genres=F.array_distinct(F.transform(_list(d["genres"]["description"]), C.genre)), features=F.array_distinct(F.transform(_list(d["categories"]["description"]), lambda x: C.slug(x))),
        platforms=F.array_compact(F.array(*(F.when(d["platforms"][f], F.lit(p)) for f, p in flags))), languages=_list(C.languages(d["supported_languages"])),
        website=d["website"], header=F.when(F.lit(artwork), F.substring_index(d["header_image"], "?", 1)),
        parent=F.when(d["fullgame"].isNotNull(), F.struct(F.lit("steam").alias("provider"), d["fullgame"]["appid"].cast("string").alias("id"))),
        dlc=F.transform(F.coalesce(d["dlc"], F.expr("cast(array() as array<bigint>)")), lambda x: x.cast("string")), review_count=d["reviews"]["total"], positive_count=d["reviews"]["positive"],
    )


def database_records(documents: DataFrame, json: str, keep: list[str]) -> DataFrame:
    """keep and record of the database's documents in the column json: companies by their flags, the store's id from the
    first external id that names it."""
    rows = documents.withColumn("_d", F.from_json(json, DATABASE)).where("_d.slug is not null")
    d = F.col("_d")
    involved = lambda flag: _list(F.filter(d["involved_companies"], lambda c: c[flag] & c["company"]["name"].isNotNull())["company"]["name"])
    store = F.get(F.filter(d["external_games"], lambda e: (e["external_game_source"] == STEAM_SOURCE) & (F.coalesce(e["uid"], F.lit("")) != "")), 0)["uid"]
    url = F.coalesce(d["url"], F.concat(F.lit("https://database.example/games/"), d["slug"]))
    return _record(
        rows, keep,
        provider=F.lit("igdb"), igdb=d["slug"], steam=store, url=url, title=d["name"], alternate_titles=F.array_sort(_list(d["alternative_names"]["name"])),
        type=F.coalesce(C.map_literal(DATABASE_TYPES)[F.lower(d["game_type"]["type"])], F.lit("game")),
        release_date=F.when(d["first_release_date"] != 0, F.date_format(F.timestamp_seconds(d["first_release_date"]), "yyyy-MM-dd")),
        developers=involved("developer"), publishers=involved("publisher"),
        platforms=F.array_distinct(F.transform(_list(d["platforms"]["name"]), C.platform)), genres=F.array_distinct(F.transform(_list(d["genres"]["name"]), C.genre)),
        tags=F.array_distinct(F.transform(_list(d["themes"]["name"]), C.genre)),
        technology=F.transform(_list(d["game_engines"]["name"]), lambda n: F.struct(n.alias("name"), F.lit("engine").alias("role"))),
        franchise=d["franchise"]["name"], series=F.get(d["collections"]["name"], 0),
        parent=F.when(d["parent_game"].isNotNull(), F.struct(F.lit("igdb").alias("provider"), d["parent_game"]["slug"].alias("id"))), links=F.create_map(F.lit("igdb"), url),
    )
