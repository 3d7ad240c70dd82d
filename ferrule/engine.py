"""The engine's entry points: each takes DataFrames and returns DataFrames, by name.

resolve() makes one game of each cluster of records and finds its companies; assemble() applies corrections, keeps what
is curated and builds the edges; build() is both, finish() stamps, counts and checks what was built, and report() says
what changed since an earlier build.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions import columns as C
from ferrule.operators import core, merge, resolver, review, rules
from ferrule.operators import ids as ids_of
from ferrule.operators.rules import Rule

#: Empty tables of the inputs that may be left out.
OPTIONAL = {
    "previous": "id string, name string, aliases array<string>, steam string, wikidata string, igdb string", "mapped_ids": "key string, id string", "mapped_names": "name string, id string",
    "company_ids": "name string, steam string, wikidata string, igdb string", "mapped_games": "key string, id string", "game_registry": "key string, id string", "previous_games": "id string",
    "registry": "key string, id string", "distinct": "a string, b string", "relationships": "from string, type string, to string, remove boolean", "excluded": "id string",
}


def _cut(df: DataFrame) -> DataFrame:
    """df checkpointed: a merge is a long expression, and what follows reads it several times."""
    return core.cut(df.sparkSession, df)


def _inputs(given: dict[str, DataFrame]) -> dict[str, DataFrame]:
    spark = given["records"].sparkSession
    return {name: spark.createDataFrame([], shape) for name, shape in OPTIONAL.items()} | given


def _provided(prefix: str = "record.") -> list[Column] | Column:
    """"provider:id" of each provider, null where it has none."""
    every = [F.when(F.col(f"{prefix}{p}").isNotNull(), F.concat(F.lit(f"{p}:"), F.col(f"{prefix}{p}"))) for p in resolver.PROVIDERS]
    return every if prefix == "" else F.array(*every)


def clusters(records: DataFrame) -> DataFrame:
    """records (ordinal, record) with cluster: records that share an id of any provider, named by their least id."""
    keyed = records.withColumn("_ids", F.array_compact(_provided())).where(F.size("_ids") > 0)
    edges = keyed.select(F.get("_ids", 0).alias("a"), F.explode("_ids").alias("b"))
    return keyed.withColumn("node", F.get("_ids", 0)).join(core.components(edges), "node").select(F.col("root").alias("cluster"), "ordinal", "record")


def resolve(given: dict[str, DataFrame], today: str) -> dict[str, DataFrame]:
    """games, credits (game, role, company), companies (id, name, created), issues, and the registries (key, id) of games
    and companies for the next build.

    given: records (ordinal, record), seeds (id, name, aliases, steam, wikidata, igdb) and any of OPTIONAL. A game keeps the
    id that is mapped or registered for one of its provider ids, whatever its title is now; a new one gets the first free
    of title, title with year, and counters. Clusters that come to one id are one game. References to companies bring the
    provider ids that company_ids know for their name; a company that no evidence names is created.
    """
    given = _inputs(given)
    named = _cut(clusters(given["records"]))
    once = _cut(merge.merge_games(named))
    keys = named.select("cluster", F.explode(F.array_compact(_provided())).alias("key")).distinct()
    dated = F.concat_ws("-", C.slug(F.col("title")), F.substring("release_date", 1, 4))
    options = F.array_distinct(F.when(F.col("release_date").isNotNull(), F.array(C.slug(F.col("title")), dated)).otherwise(F.array(C.slug(F.col("title")))))
    asked = once.join(keys.groupBy("cluster").agg(F.array_sort(F.collect_set("key")).alias("ids")), "cluster").select(F.col("cluster").alias("key"), "ids", options.alias("candidates"))
    ids = _cut(ids_of.stable_ids(asked, given["mapped_games"], given["game_registry"], given["previous_games"], "steam:"))
    issues = ids.where("size(others) > 0").select(F.lit("potential-duplicate").alias("kind"), F.col("id").alias("subject"), F.lit("id").alias("field"), F.array_join("others", ", ").alias("details"), F.lit(False).alias("suggested"))
    whole = named.join(ids.select(F.col("key").alias("cluster"), "id"), "cluster").select(F.col("id").alias("cluster"), "ordinal", "record")
    games = _cut(merge.dated_status(merge.merge_games(whole), today)).withColumnRenamed("cluster", "id")
    registered = keys.join(ids.select(F.col("key").alias("cluster"), "id"), "cluster").select("key", "id").union(given["game_registry"].select("key", "id")).groupBy("key").agg(F.min("id").alias("id"))

    said = games.select("id", F.explode(F.array(F.struct(F.lit("developer").alias("role"), F.col("developers").alias("names")), F.struct(F.lit("publisher").alias("role"), F.col("publishers").alias("names")))).alias("x")).select("id", "x.role", F.explode("x.names").alias("name"))
    brought = given["company_ids"].groupBy("name").agg(*(F.min(p).alias(p) for p in resolver.PROVIDERS))
    refs = said.select("name").distinct().join(brought, "name", "left").withColumn("ref", F.col("name"))
    shared = ["id", "name", "aliases", *resolver.PROVIDERS]
    entries = given["seeds"].select(*shared).withColumn("seeded", F.lit(True))
    entries = entries.unionByName(given["previous"].join(entries.select("id"), "id", "left_anti").select(*shared).withColumn("seeded", F.lit(False)))
    found, known = resolver.resolve_all(_cut(refs), entries, given["mapped_ids"], given["mapped_names"], given["registry"], given["distinct"])
    credits = said.join(found.select(F.col("ref").alias("name"), F.col("id").alias("company")), "name").select(F.col("id").alias("game"), "role", "company").distinct()
    remembered = found.join(refs, "ref").select(F.explode(F.array_compact(F.array(F.concat(F.lit("name:"), C.company_name(F.col("name"))), *_provided("")))).alias("key"), "id")
    remembered = remembered.join(given["registry"].select("key"), "key", "left_anti").groupBy("key").agg(F.min("id").alias("id")).union(given["registry"].select("key", "id"))
    return {"games": _cut(games), "credits": _cut(credits), "companies": _cut(known.select("id", "name", "created")), "issues": _cut(issues), "game_registry": _cut(registered), "registry": _cut(remembered)}


def assemble(given: dict[str, DataFrame], found: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """games, companies and edges (id, from, type, to) of what resolve() found.

    Excluded companies leave with their credits; games stay that have a credit of a seeded company; companies that
    aren't seeded stay while a game refers to them. Edges by hand come last: they add, or remove, by (from, type, to).
    """
    given = _inputs(given)
    gone = given["excluded"].select(F.col("id").alias("company"))
    credits = found["credits"].join(gone, "company", "left_anti")
    seeded = given["seeds"].select(F.col("id").alias("company")).join(gone, "company", "left_anti")
    games = _cut(core.inclusion(found["games"], "id", credits.withColumnRenamed("game", "id"), seeded, "company"))
    credits = credits.join(games.select(F.col("id").alias("game")), "game", "left_semi")
    used = seeded.select(F.col("company").alias("id")).union(credits.select("company")).distinct()
    companies = found["companies"].join(gone.withColumnRenamed("company", "id"), "id", "left_anti").join(used, "id", "left_semi")
    ids = functools.reduce(DataFrame.unionByName, (games.where(F.col(p).isNotNull()).select(F.lit(p).alias("provider"), F.col(p).alias("id"), F.col("id").alias("cluster")) for p in resolver.PROVIDERS))
    related = merge.known_relations(games.withColumnRenamed("id", "cluster"), ids)
    own = [
        credits.select(F.col("company").alias("from"), F.col("role").alias("type"), F.col("game").alias("to")),
        games.select(F.col("id").alias("from"), F.explode("technology").alias("t")).select("from", F.concat(F.lit("uses-"), "t.role").alias("type"), F.col("t.id").alias("to")),
        related.select(F.explode("dlc").alias("from"), F.lit("dlc-of").alias("type"), F.col("cluster").alias("to")),
    ]
    edges = functools.reduce(DataFrame.unionByName, own).select("*", F.lit(False).alias("remove"), F.lit(0).alias("step"))
    manual = given["relationships"].select("from", "type", "to", F.coalesce("remove", F.lit(False)).alias("remove"), F.lit(1).alias("step"))
    last = core.last_wins(edges.unionByName(manual), ["from", "type", "to"], "step").where("not remove")
    kept = {name: found[name] for name in ("issues", "game_registry", "registry") if name in found}
    return kept | {"games": games, "companies": _cut(companies), "edges": _cut(last.select(F.concat_ws(":", "from", "type", "to").alias("id"), "from", "type", "to"))}


def build(given: dict[str, DataFrame], today: str) -> dict[str, DataFrame]:
    return assemble(given, resolve(given, today))


def report(before: dict[str, DataFrame], after: dict[str, DataFrame], seeds: DataFrame) -> DataFrame:
    """Review candidates of the changes between two builds."""
    spark = seeds.sparkSession

    def of(built: dict[str, DataFrame]) -> dict[str, DataFrame]:
        claims = built["games"].select(F.col("id").alias("game"), F.explode("technology").alias("t")).select("game", F.col("t.id").alias("technology"), F.col("t.confidence").alias("confidence"))
        return {"games": built["games"].select("id"), "companies": built["companies"].select("id", F.lit(None).cast("string").alias("parent_name")), "edges": built["edges"].select("from", "type", "to"), "claims": claims}

    issues = after.get("issues", spark.createDataFrame([], "kind string, subject string, field string, details string, suggested boolean"))
    return review.candidates(of(before), of(after), seeds.select("id"), issues, spark.createDataFrame([], "id string"))


#: What edges of a type lead from and to; other types lead from a company to a game.
ENDS = {"subsidiary-of": ("company", "company"), "dlc-of": ("game", "game"), "remaster-of": ("game", "game"), "port-of": ("game", "game")} | {f"uses-{r}": ("game", "technology") for r in ("engine", "middleware", "language", "tool")}
#: Fields of a game that move from day to day and don't count as a change of it, and those that finish() makes.
DAILY, MADE = ("review_count", "positive_count"), ("content_hash", "last_updated")
RULES = {
    "game": [Rule("title", "required"), Rule("release_date", "pattern", r"^\d{4}(-\d{2}(-\d{2})?)?$"), Rule("positive_count", "least", 0)],
    "company": [Rule("name", "required"), Rule("name", "exclusive", ("company name", "company"), level="warning")],
    "edge": [Rule("from", "reference", by="from_type"), Rule("to", "reference", by="to_type")],
}


def stamped(table: DataFrame, now: str, before: DataFrame | None = None, daily: tuple[str, ...] = DAILY) -> DataFrame:
    """table with content_hash, of all columns but the daily ones, and last_updated: that of `before` (id, content_hash,
    last_updated) where the hash is the same, now where it isn't or the id is new. The order of columns and of a map's
    entries doesn't count, that of a list does; a null and an absent field are different."""
    kept = sorted(c for c in table.columns if c not in daily + MADE)
    line = C.canonical_json(F.to_json(F.struct(*(F.col(f"`{c}`") for c in kept)), {"ignoreNullFields": "false"}))
    rows = table.drop(*MADE).withColumn("content_hash", F.sha2(line, 256))
    if before is None:
        return rows.withColumn("last_updated", F.lit(now))
    old = before.select("id", F.col("content_hash").alias("_hash"), F.col("last_updated").alias("_at"))
    stamp = F.when(F.col("_hash") == F.col("content_hash"), F.col("_at")).otherwise(now)
    return rows.join(old, "id", "left").withColumn("last_updated", stamp).drop("_hash", "_at")


def company_statistics(companies: DataFrame, games: DataFrame, edges: DataFrame, least_reviews: int = 100) -> DataFrame:
    """One row a company, those without games too: counts, review sums, percentages, extremes by reviews and by release.

    A game that a company both developed and published counts once. The plain average is over games of least_reviews or
    more, the weighted one over all reviews. Extremes are null where no game qualifies; ties go to the smaller id, the
    most recent release to the greater.
    """
    role = lambda r: F.max((F.col("type") == r).cast("int"))
    credits = edges.where(F.col("type").isin("developer", "publisher")).groupBy(F.col("from").alias("company"), F.col("to").alias("id")).agg(role("developer").alias("dev"), role("publisher").alias("pub"))
    reviews, good = F.coalesce("review_count", F.lit(0)), F.coalesce("positive_count", F.lit(0))
    out = (F.col("release_status").isin("released", "early-access")) & F.col("release_date").isNotNull()
    facts = games.select("id", reviews.alias("reviews"), good.alias("good"), F.when(out, F.col("release_date")).alias("released"), (F.col("positive_count").isNotNull()).alias("told"), "technology")
    j = credits.join(facts, "id")
    part = F.when(F.col("told") & (F.col("reviews") >= least_reviews), C.rounded(C.ratio(F.col("good"), F.col("reviews")) * 100, 1))
    when = F.when(F.col("released").isNotNull(), F.struct("released", "id"))
    sums = j.groupBy("company").agg(
        F.count("*").alias("game_count"), F.sum("dev").alias("developed_count"), F.sum("pub").alias("published_count"), F.sum("reviews").alias("total_reviews"), C.rounded(F.avg(part), 1).alias("average_positive"),
        C.rounded(C.ratio(F.sum("good"), F.sum("reviews")) * 100, 1).alias("weighted_positive"), F.min(F.when(F.col("reviews") > 0, F.struct((-F.col("reviews")).alias("r"), F.col("id"))))["id"].alias("most_reviewed"),
        F.min(when)["id"].alias("first_release"), F.max(when)["id"].alias("latest_release"),
    )
    used = j.select("company", F.explode("technology").alias("t")).select("company", "t.id", "t.role").distinct()
    tech = used.groupBy("company").agg(F.size(F.collect_set("id")).cast("long").alias("technology_count"), F.array_sort(F.collect_set(F.when(F.col("role") == "engine", F.col("id")))).alias("engines"))
    every = companies.select(F.col("id").alias("company")).join(sums, "company", "left").join(tech, "company", "left")
    zero = ("game_count", "developed_count", "published_count", "total_reviews", "technology_count")
    return every.fillna(0, list(zero)).withColumn("engines", F.coalesce("engines", F.expr("cast(array() as array<string>)")))


def finish(built: dict[str, DataFrame], now: str, before: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """What build() gave, with stamped games and companies, typed edges, company_statistics and problems.

    before is what finish() gave for an earlier build: an entity that is the same keeps its last_updated. problems
    (level, kind, id, path, message) has dangling and mistyped ends of edges, repeated ids and bad fields as errors, names
    that two companies have as warnings; a build with errors isn't fit to be published.
    """
    at = lambda name: None if before is None else before[name]
    games, companies = _cut(stamped(built["games"], now, at("games"))), _cut(stamped(built["companies"], now, at("companies")))
    ends = F.create_map(*(x for kind, (a, b) in ENDS.items() for x in (F.lit(kind), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))))
    end = F.coalesce(F.try_element_at(ends, F.col("type")), F.struct(F.lit("company").alias("a"), F.lit("game").alias("b")))
    edges = built["edges"].withColumn("_end", end).withColumns({"from_type": F.col("_end.a"), "to_type": F.col("_end.b")}).drop("_end")
    technologies = games.select(F.explode("technology").alias("t")).select("t.id").distinct()
    problems = rules.check({"game": games, "company": companies, "edge": edges, "technology": technologies}, RULES)
    return built | {"games": games, "companies": companies, "edges": edges, "company_statistics": company_statistics(companies, games, edges), "problems": problems}
