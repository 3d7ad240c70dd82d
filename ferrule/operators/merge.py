"""Records of one thing from several providers as one row, field by field, with where each value came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions import columns as C

#: Whose value counts first, by field.
TITLE_ORDER, PEOPLE_ORDER, SERIES_ORDER = ("steam", "igdb", "wikidata"), ("steam", "wikidata", "igdb"), ("igdb", "wikidata")
#: Fields of which one provider's value is picked.
PICKED = {
    "title": TITLE_ORDER, "type": TITLE_ORDER, "release_date": TITLE_ORDER, "developers": PEOPLE_ORDER, "publishers": PEOPLE_ORDER,
    "description": ("steam",), "features": ("steam",), "languages": ("steam",), "header": ("steam",), "website": TITLE_ORDER,
    "franchise": SERIES_ORDER, "series": SERIES_ORDER, "parent": PEOPLE_ORDER,
}
_NONE = "cast(array() as array<string>)"


def _blank(value: Column, name: str) -> Column:
    if name in ("developers", "publishers", "features", "languages"):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull() if name == "parent" else value.isNull() | (value == "")


def _ranked(records: Column, name: str, order: tuple[str, ...]) -> Column:
    """The providers' values that aren't blank, as (rank, ordinal, provider, value), in order; other providers don't count."""
    places = F.array(*(F.lit(p) for p in order))
    each = F.transform(records, lambda r: F.struct(F.array_position(places, r["record"]["provider"]).alias("rank"), r["ordinal"].alias("ordinal"), r["record"]["provider"].alias("provider"), r["record"][name].alias("value")))
    return F.array_sort(F.filter(each, lambda x: (x["rank"] > 0) & ~_blank(x["value"], name)))


def _union(records: Column, name: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.transform(records, lambda r: F.coalesce(r["record"][name], F.expr(_NONE))))))


def merge_games(records: DataFrame) -> DataFrame:
    """records (cluster, ordinal, record as in sources.records.RECORD) as one row per cluster.

    Picked fields take the first provider's value that isn't blank; lists of genres, tags, platforms and titles are
    united; links are united with the first provider's value for a name. A cluster has few records, which meet in one
    array; nothing but that aggregation is shuffled. provenance has (field, provider, confidence, alternatives): the
    later values of a picked field that differ, as JSON.
    """
    # a map has no order; its entries have one
    entries = F.coalesce(F.map_entries("record.links"), F.expr("cast(array() as array<struct<key:string,value:string>>)"))
    grouped = records.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.col("record").withField("links", entries).alias("record")))).alias("r"))
    r = F.col("r")
    staged = grouped.withColumns({f"_{name}": _ranked(r, name, order) for name, order in PICKED.items()})
    first = {name: F.get(F.col(f"_{name}"), 0)["value"] for name in PICKED}
    titles = F.flatten(F.transform(r, lambda x: F.concat(F.coalesce(x["record"]["alternate_titles"], F.expr(_NONE)), F.array(F.coalesce(x["record"]["title"], F.lit(""))))))
    title = F.coalesce(first["title"], F.col("cluster").cast("string"))
    dates = F.transform(r, lambda x: x["record"]["release_date"])
    date = C.refined_date(first["release_date"], F.filter(dates, lambda d: d.isNotNull()))
    steam = F.filter(r, lambda x: x["record"]["provider"] == "steam")
    status = F.get(F.filter(F.transform(steam, lambda x: x["record"]["release_status"]), lambda s: s.isNotNull()), 0)
    one_id = lambda name: F.get(F.array_sort(F.filter(F.transform(r, lambda x: x["record"][name]), lambda i: i.isNotNull())), 0)
    numeric = F.array_min(F.transform(F.filter(r, lambda x: x["record"]["steam"].isNotNull()), lambda x: x["record"]["steam"].cast("bigint")))
    # a name keeps the link of the provider that comes first; a picked website is the official one
    by_rank = F.array_sort(F.transform(r, lambda x: F.struct(F.array_position(F.array(*(F.lit(p) for p in TITLE_ORDER)), x["record"]["provider"]).alias("rank"), x["ordinal"].alias("ordinal"), x["record"]["links"].alias("links"))))
    listed = F.flatten(F.transform(by_rank, lambda x: x["links"]))
    names = F.array_sort(F.array_distinct(F.concat(F.transform(listed, lambda e: e["key"]), F.when(first["website"].isNotNull(), F.array(F.lit("official"))).otherwise(F.expr(_NONE)))))
    link = lambda n: F.when((n == "official") & first["website"].isNotNull(), first["website"]).otherwise(F.get(F.filter(listed, lambda e: e["key"] == n), 0)["value"])
    claims = F.flatten(F.transform(r, lambda x: F.transform(F.coalesce(x["record"]["technology"], F.expr("cast(array() as array<struct<name:string,role:string>>)")), lambda t: F.struct(t["role"].alias("role"), C.slug(t["name"]).alias("id"), x["record"]["provider"].alias("provider")))))
    pairs = F.array_sort(F.array_distinct(F.transform(claims, lambda c: F.struct(c["role"].alias("role"), c["id"].alias("id")))))
    reporters = lambda p: F.array_distinct(F.transform(F.filter(claims, lambda c: (c["role"] == p["role"]) & (c["id"] == p["id"])), lambda c: c["provider"]))
    technology = F.transform(pairs, lambda p: F.struct(p["role"].alias("role"), p["id"].alias("id"), F.when((F.size(reporters(p)) > 1) | F.array_contains(reporters(p), "steam"), "high").otherwise("medium").alias("confidence")))
    reviewed = F.filter(steam, lambda x: x["record"]["review_count"].isNotNull())
    provenance = F.array(*(_provenance(name) for name in PICKED))
    return staged.select(
        "cluster", title.alias("title"), F.array_sort(F.array_distinct(F.filter(titles, lambda t: (t != "") & (t != title)))).alias("alternate_titles"),
        F.coalesce(first["type"], F.lit("game")).alias("type"), date.alias("release_date"), C.precision_of(date).alias("precision"),
        F.coalesce(status, F.when(date.isNull(), "unknown")).alias("release_status"),
        *(F.array_sort(F.array_distinct(F.coalesce(first[n], F.expr(_NONE)))).alias(n) for n in ("developers", "publishers")),
        first["description"].alias("description"), F.array_sort(F.array_distinct(F.filter(F.transform(_union(r, "genres"), C.genre), lambda g: ~g.isin(*C.NON_GAMEPLAY)))).alias("genres"),
        F.array_sort(F.array_distinct(F.transform(_union(r, "tags"), C.genre))).alias("tags"), F.coalesce(first["features"], F.expr(_NONE)).alias("features"),
        F.array_sort(F.array_distinct(F.transform(_union(r, "platforms"), C.platform))).alias("platforms"), F.coalesce(first["languages"], F.expr(_NONE)).alias("languages"),
        F.coalesce(F.get(F.filter(F.transform(steam, lambda x: x["record"]["steam"]), lambda i: i.isNotNull()), 0), numeric.cast("string")).alias("steam"), one_id("wikidata").alias("wikidata"), one_id("igdb").alias("igdb"),
        F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), link(n).alias("value")))).alias("links"), first["header"].alias("header"), technology.alias("technology"),
        *(F.when(first[n].isNotNull(), F.struct(C.slug(first[n]).alias("id"), first[n].alias("name"))).alias(n) for n in ("franchise", "series")),
        first["parent"].alias("parent"), _union(r, "dlc").alias("dlc"), F.get(reviewed, 0)["record"]["review_count"].alias("review_count"), F.get(reviewed, 0)["record"]["positive_count"].alias("positive_count"),
        F.array_sort(F.array_distinct(F.transform(r, lambda x: F.struct(x["record"]["provider"].alias("provider"), x["record"]["url"].alias("url"))))).alias("sources"),
        F.array_sort(F.filter(provenance, lambda p: p["provider"].isNotNull())).alias("provenance"),
    )


def _provenance(name: str) -> Column:
    ranked = F.col(f"_{name}")
    text = lambda v: v if name not in ("developers", "publishers", "features", "languages", "parent") else F.to_json(v)
    provider = F.get(ranked, 0)["provider"]
    values = F.transform(ranked, lambda x: text(x["value"]))
    others = F.array_distinct(F.filter(values, lambda v: v != F.get(values, 0)))
    return F.struct(F.lit(name).alias("field"), provider.alias("provider"), F.when(provider == "steam", "high").otherwise("medium").alias("confidence"), F.coalesce(others, F.expr(_NONE)).alias("alternatives"))


def dated_status(games: DataFrame, today: str) -> DataFrame:
    """games with a release status for those that have a date and no status of their own."""
    return games.withColumn("release_status", F.coalesce("release_status", C.release_status(F.col("release_date"), today), F.lit("unknown")))


def known_relations(games: DataFrame, id_of: DataFrame) -> DataFrame:
    """(cluster, parent_game, dlc): relations by reported ids to clusters of this build (id_of: provider, id, cluster).

    Unknown ids and a game's own are left out; a game that is another's parent has it among its dlc, and the other way.
    """
    by = id_of.select("provider", "id", F.col("cluster").alias("target"))
    parents = games.where("parent is not null").select("cluster", F.col("parent.provider").alias("provider"), F.col("parent.id").alias("id")).join(by, ["provider", "id"]).where("cluster <> target").select(F.col("target").alias("game"), F.col("cluster").alias("part"))
    parts = games.select("cluster", F.lit("steam").alias("provider"), F.explode("dlc").alias("id")).join(by, ["provider", "id"]).where("cluster <> target").select(F.col("cluster").alias("game"), F.col("target").alias("part"))
    pairs = parents.unionByName(parts).distinct()
    listed = pairs.groupBy(F.col("game").alias("cluster")).agg(F.array_sort(F.collect_list("part")).alias("dlc"))
    whole = pairs.groupBy(F.col("part").alias("cluster")).agg(F.min("game").alias("parent_game"))
    return games.select("cluster").join(whole, "cluster", "left").join(listed, "cluster", "left").select("cluster", "parent_game", F.coalesce("dlc", F.array()).alias("dlc"))


def merge_companies(records: DataFrame, seeds: DataFrame, prior: DataFrame, created: DataFrame) -> DataFrame:
    """One row per company id that any of the four knows, with name, status, parent and ids.

    records: id, ordinal, name, parent, dissolved, ids; seeds, prior, created: id, name (prior and created: ids too). The
    name is the first that isn't blank of record, seed, prior and created, else the id. A parent makes a subsidiary,
    else an end makes it defunct. Ids are the records', then created, then prior ones.
    """
    said = records.groupBy("id").agg(
        *(F.get(F.array_sort(F.filter(F.collect_list(F.struct("ordinal", F.col(c).alias("v"))), lambda x: x["v"].isNotNull() & (x["v"].cast("string") != ""))), 0)["v"].alias(f"r_{c}") for c in ("name", "parent", "ids")),
        F.coalesce(F.max(F.col("dissolved").cast("int")) == 1, F.lit(False)).alias("dissolved"),
    )
    out = said
    for other, name in ((seeds, "s"), (prior, "p"), (created, "c")):
        out = out.join(other.select("id", *(F.col(c).alias(f"{name}_{c}") for c in other.columns if c != "id")), "id", "full")
    named = lambda c: F.when(F.col(c) != "", F.col(c))
    status = F.when(F.col("r_parent").isNotNull(), "subsidiary").when(F.col("dissolved"), "defunct").otherwise("independent")
    return out.select("id", F.coalesce(named("r_name"), named("s_name"), named("p_name"), named("c_name"), F.col("id").cast("string")).alias("name"), status.alias("status"), F.col("r_parent").alias("parent"), F.coalesce("r_ids", "c_ids", "p_ids").alias("ids"))
