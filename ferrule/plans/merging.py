"""Merging of provider records, overlays and overrides. Three providers report each part; the key decides what each says."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.operators.core import priority_pick, sorted_union
from ferrule.plans.base import query

PROVIDERS = """r AS (
  SELECT p_partkey AS id, 'steam' AS provider, 1 AS rank, 1 AS ordinal, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS title, p_type AS genre FROM part WHERE p_partkey % 3 <> 0
  UNION ALL SELECT p_partkey, 'igdb', 2, 2, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE upper(p_name) END, p_brand FROM part
  UNION ALL SELECT p_partkey, 'wikidata', 3, 3, p_name || ' (game)', p_type FROM part WHERE p_partkey % 2 = 0)"""


def providers(t):
    k = F.col("p_partkey")
    steam = t.part.where(k % 3 != 0).select(k.alias("id"), F.lit("steam").alias("provider"), F.lit(1).alias("rank"), F.lit(1).alias("ordinal"), F.when(k % 5 == 0, "").otherwise(F.col("p_name")).alias("title"), F.col("p_type").alias("genre"))
    igdb = t.part.select(k.alias("id"), F.lit("igdb").alias("provider"), F.lit(2).alias("rank"), F.lit(2).alias("ordinal"), F.when(k % 4 != 0, F.upper("p_name")).alias("title"), F.col("p_brand").alias("genre"))
    wikidata = t.part.where(k % 2 == 0).select(k.alias("id"), F.lit("wikidata").alias("provider"), F.lit(3).alias("rank"), F.lit(3).alias("ordinal"), F.concat("p_name", F.lit(" (game)")).alias("title"), F.col("p_type").alias("genre"))
    return steam.unionByName(igdb).unionByName(wikidata)


PICK = f"""WITH {PROVIDERS}, k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank, ordinal) AS n FROM r WHERE title IS NOT NULL AND title <> ''),
  f AS (SELECT * FROM k WHERE n = 1)"""


@query("priority_pick", PICK + " SELECT id, title, provider, CASE provider WHEN 'steam' THEN 'high' ELSE 'medium' END AS confidence FROM f")
def priority_pick_query(t):
    p = priority_pick(providers(t), ["id"], "title", "rank", "ordinal")
    provider = F.get(F.array(F.lit("steam"), F.lit("igdb"), F.lit("wikidata")), F.col("rank") - 1)
    return p.select("id", "title", provider.alias("provider"), F.when(provider == "steam", "high").otherwise("medium").alias("confidence"))


@query("pick_alternatives", PICK + " SELECT f.id, coalesce(string_agg(k.title, '|' ORDER BY k.rank), '') AS alternatives FROM f LEFT JOIN k ON k.id = f.id AND k.title <> f.title GROUP BY 1")
def pick_alternatives(t):
    return priority_pick(providers(t), ["id"], "title", "rank", "ordinal").select("id", F.array_join("alternatives", "|").alias("alternatives"))


@query("union_fields", f"WITH {PROVIDERS} SELECT id, string_agg(DISTINCT genre, '|' ORDER BY genre) AS genres FROM r GROUP BY 1")
def union_fields(t):
    return sorted_union(providers(t), ["id"], F.col("genre"), "genres").select("id", F.array_join("genres", "|").alias("genres"))


LINKS = f"{PROVIDERS}, l AS (SELECT id, rank, unnest(['official', provider]) AS name, unnest(['https://' || provider || '.example/' || id, 'https://' || provider || '.example/p/' || id]) AS url FROM r)"


@query("map_first_wins", f"WITH {LINKS} SELECT id, name, url FROM (SELECT *, row_number() OVER (PARTITION BY id, name ORDER BY rank) AS n FROM l) WHERE n = 1")
def map_first_wins(t):
    host = F.concat(F.lit("https://"), "provider", F.lit(".example/"))
    links = F.create_map(F.lit("official"), F.concat(host, F.col("id").cast("string")), F.col("provider"), F.concat(host, F.lit("p/"), F.col("id").cast("string")))
    long = providers(t).select("id", "rank", F.explode(links).alias("name", "url"))
    return long.groupBy("id", "name").agg(F.min(F.struct("rank", "url"))["url"].alias("url"))


@query("map_right_wins", "SELECT p_partkey AS id, 'brand' AS name, CASE WHEN p_partkey % 2 = 0 THEN 'seed' ELSE p_brand END AS value FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part UNION ALL SELECT p_partkey, 'size', p_size::VARCHAR FROM part WHERE p_partkey % 2 = 0")
def map_right_wins(t):
    left = F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type")
    right = F.when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("brand"), F.lit("seed"), F.lit("size"), F.col("p_size").cast("string"))).otherwise(F.expr("cast(map() as map<string,string>)"))
    return t.part.select(F.col("p_partkey").alias("id"), F.explode(F.map_zip_with(left, right, lambda k, a, b: F.coalesce(b, a))).alias("name", "value"))


CLAIMS = "c AS (SELECT l_partkey AS game, CASE l_linenumber % 2 WHEN 0 THEN 'engine' ELSE 'language' END AS role, 'tech' || (l_suppkey % 5) AS tech, l_suppkey % 3 AS provider, l_orderkey AS ordinal FROM lineitem)"


@query(
    "claim_confidence",
    f"""WITH {CLAIMS}, s AS (SELECT game, role, tech, count(DISTINCT provider) AS providers, min(provider) AS rank FROM c GROUP BY 1, 2, 3)
    SELECT game, role, tech, CASE rank WHEN 0 THEN 'wikidata' WHEN 1 THEN 'igdb' ELSE 'steam' END AS source, CASE WHEN providers > 1 OR rank = 2 THEN 'high' ELSE 'medium' END AS confidence FROM s""",
)
def claim_confidence(t):
    role = F.when(F.col("l_linenumber") % 2 == 0, "engine").otherwise("language")
    claims = t.lineitem.select(F.col("l_partkey").alias("game"), role.alias("role"), F.concat(F.lit("tech"), (F.col("l_suppkey") % 5).cast("string")).alias("tech"), (F.col("l_suppkey") % 3).alias("provider"))
    s = claims.groupBy("game", "role", "tech").agg(F.size(F.collect_set("provider")).alias("providers"), F.min("provider").alias("first"))
    source = F.get(F.array(F.lit("wikidata"), F.lit("igdb"), F.lit("steam")), F.col("first").cast("int"))
    return s.select("game", "role", "tech", source.alias("source"), F.when((F.col("providers") > 1) | (source == "steam"), "high").otherwise("medium").alias("confidence"))


@query(
    "conflict_detection",
    """WITH d AS (SELECT l_partkey AS game, list_sort(list(DISTINCT l_suppkey) FILTER (l_linenumber % 2 = 1)) AS a, list_sort(list(DISTINCT l_suppkey) FILTER (l_linenumber % 2 = 0)) AS b FROM lineitem GROUP BY 1)
    SELECT game, len(a)::BIGINT AS chosen, len(b)::BIGINT AS reported FROM d WHERE a IS NOT NULL AND b IS NOT NULL AND NOT list_has_any(a, b)""",
)
def conflict_detection(t):
    odd = F.col("l_linenumber") % 2 == 1
    d = t.lineitem.groupBy(F.col("l_partkey").alias("game")).agg(F.collect_set(F.when(odd, F.col("l_suppkey"))).alias("a"), F.collect_set(F.when(~odd, F.col("l_suppkey"))).alias("b"))
    return d.where((F.size("a") > 0) & (F.size("b") > 0) & ~F.arrays_overlap("a", "b")).select("game", F.size("a").cast("long").alias("chosen"), F.size("b").cast("long").alias("reported"))


# patches: (id, ordinal, op, path, value); set beats the base, the last entry of a path counts
PATCHES = """p AS (SELECT p_partkey AS id, 1 AS ordinal, 'set' AS op, 'title' AS path, 'Patched ' || p_partkey AS value FROM part WHERE p_partkey % 4 = 0
  UNION ALL SELECT p_partkey, 2, 'set', 'title', 'Again ' || p_partkey FROM part WHERE p_partkey % 8 = 0
  UNION ALL SELECT p_partkey, 3, 'append', 'tags', 'extra' FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT p_partkey, 4, 'append', 'tags', p_brand FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT p_partkey, 5, 'remove', 'tags', p_type FROM part WHERE p_partkey % 5 = 0)"""


def patches(t):
    k = F.col("p_partkey")

    def one(every, ordinal, op, path, value):
        return t.part.where(k % every == 0).select(k.alias("id"), F.lit(ordinal).alias("ordinal"), F.lit(op).alias("op"), F.lit(path).alias("path"), value.alias("value"))

    out = one(4, 1, "set", "title", F.concat(F.lit("Patched "), k.cast("string")))
    for more in (one(8, 2, "set", "title", F.concat(F.lit("Again "), k.cast("string"))), one(3, 3, "append", "tags", F.lit("extra")), one(3, 4, "append", "tags", F.col("p_brand")), one(5, 5, "remove", "tags", F.col("p_type"))):
        out = out.unionByName(more)
    return out


def patched(base, entries):
    """base (id, title, tags) after the entries: the last set, then appends not yet there in order, then removals."""
    of = entries.groupBy("id").agg(
        F.max(F.when(F.col("op") == "set", F.struct("ordinal", "value"))).alias("last"),
        F.array_sort(F.collect_list(F.when(F.col("op") == "append", F.struct("ordinal", "value")))).alias("more"),
        F.collect_set(F.when(F.col("op") == "remove", F.col("value"))).alias("less"),
    )
    none = F.expr("cast(array() as array<string>)")
    more = F.coalesce(F.transform("more", lambda x: x["value"]), none)
    return base.join(of, "id", "left").select("id", F.coalesce(F.col("last.value"), "title").alias("title"), F.array_except(F.array_distinct(F.concat("tags", more)), F.coalesce("less", none)).alias("tags"), F.col("last").isNotNull().alias("touched"))


def base_entities(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.array("p_type", "p_brand").alias("tags"))


@query(
    "override_apply",
    f"""WITH {PATCHES}, s AS (SELECT id, last(value ORDER BY ordinal) AS title FROM p WHERE op = 'set' GROUP BY 1)
    SELECT p_partkey AS id, coalesce(s.title, p_name) AS title, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type || '|' END || p_brand || CASE WHEN p_partkey % 3 = 0 THEN '|extra' ELSE '' END AS tags FROM part LEFT JOIN s ON s.id = p_partkey""",
)
def override_apply(t):
    return patched(base_entities(t), patches(t)).select("id", "title", F.array_join("tags", "|").alias("tags"))


@query("dot_path_patch", "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'patched' ELSE c_mktsegment END AS segment, c_nationkey AS nation FROM customer")
def dot_path_patch(t):
    nested = t.customer.select(F.col("c_custkey").alias("id"), F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("where"))
    done = nested.withColumn("where", F.when(F.col("id") % 3 == 0, F.col("where").withField("segment", F.lit("patched"))).otherwise(F.col("where")))
    return done.select("id", "where.segment", "where.nation")


@query(
    "override_exclude_create",
    """WITH b AS (SELECT p_partkey AS id, p_name AS title FROM part WHERE p_partkey % 10 <> 0), e AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN 'exclude' WHEN p_partkey % 20 = 0 THEN 'create' ELSE 'set' END AS action FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 10 = 0)
    SELECT id, title, 'kept' AS state FROM b WHERE id NOT IN (SELECT id FROM e WHERE action = 'exclude')
    UNION ALL SELECT id, 'manual', 'created' FROM e WHERE action = 'create' UNION ALL SELECT id, NULL, 'problem' FROM e WHERE action = 'set' AND id NOT IN (SELECT id FROM b)""",
)
def override_exclude_create(t):
    k = F.col("p_partkey")
    b = t.part.where(k % 10 != 0).select(k.alias("id"), F.col("p_name").alias("title"))
    e = t.part.where((k % 7 == 0) | (k % 10 == 0)).select(k.alias("id"), F.when(k % 7 == 0, "exclude").when(k % 20 == 0, "create").otherwise("set").alias("action"))
    kept = b.join(e.where("action = 'exclude'"), "id", "left_anti").withColumn("state", F.lit("kept"))
    created = e.where("action = 'create'").select("id", F.lit("manual").alias("title"), F.lit("created").alias("state"))
    problems = e.where("action = 'set'").join(b, "id", "left_anti").select("id", F.lit(None).cast("string").alias("title"), F.lit("problem").alias("state"))
    return kept.unionByName(created).unionByName(problems)


@query(
    "seed_overlay",
    """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN 'Seed ' || s_suppkey ELSE s_name END AS name, CASE WHEN s_suppkey % 4 = 0 AND s_name < 'seed alias' THEN s_name || '|seed alias' WHEN s_suppkey % 4 = 0 THEN 'seed alias|' || s_name ELSE s_name END AS aliases FROM supplier""",
)
def seed_overlay(t):
    k = F.col("s_suppkey")
    seeds = t.supplier.where(k % 4 == 0).select(k, F.concat(F.lit("Seed "), k.cast("string")).alias("seed_name"), F.array(F.lit("seed alias")).alias("seed_aliases"))
    both = t.supplier.join(seeds, "s_suppkey", "left")
    aliases = F.array_sort(F.array_union(F.array("s_name"), F.coalesce("seed_aliases", F.expr("cast(array() as array<string>)"))))
    return both.select(k.alias("id"), F.coalesce("seed_name", "s_name").alias("name"), F.array_join(aliases, "|").alias("aliases"))


@query("seed_eligibility", "SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0 AND coalesce(CASE s_suppkey % 5 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END, true)")
def seed_eligibility(t):
    k = F.col("s_suppkey")
    include = F.when(k % 5 == 0, False).when(k % 5 == 1, F.lit(None).cast("boolean")).otherwise(True)
    return t.supplier.where((k % 3 != 0) & F.coalesce(include, F.lit(True))).select("s_suppkey")


@query(
    "merge_full_record",
    f"""WITH {PROVIDERS}, a AS (SELECT id, string_agg(DISTINCT genre, '|' ORDER BY genre) AS genres, count(DISTINCT provider)::BIGINT AS providers, string_agg(DISTINCT provider, '|' ORDER BY provider) AS sources FROM r GROUP BY 1),
    k AS (SELECT id, title, row_number() OVER (PARTITION BY id ORDER BY rank, ordinal) AS n FROM r WHERE title IS NOT NULL AND title <> '')
    SELECT a.id, coalesce(k.title, a.id::VARCHAR) AS title, genres, providers, sources, 'steam:' || a.id || CASE WHEN a.id % 2 = 0 THEN '|wikidata:Q' || a.id ELSE '' END AS ids FROM a LEFT JOIN k ON k.id = a.id AND k.n = 1""",
)
def merge_full_record(t):
    r = providers(t)
    a = r.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("genre")), "|").alias("genres"), F.size(F.collect_set("provider")).cast("long").alias("providers"), F.array_join(F.array_sort(F.collect_set("provider")), "|").alias("sources"))
    p = priority_pick(r, ["id"], "title", "rank", "ordinal").select("id", "title")
    k = F.col("id").cast("string")
    ids = F.array_join(F.array_compact(F.array(F.concat(F.lit("steam:"), k), F.when(F.col("id") % 2 == 0, F.concat(F.lit("wikidata:Q"), k)))), "|")
    return a.join(p, "id", "left").select("id", F.coalesce("title", k).alias("title"), "genres", "providers", "sources", ids.alias("ids"))


@query(
    "merge_company",
    """SELECT s_suppkey AS id, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, CASE WHEN s_suppkey % 3 = 0 THEN 'Seed' END, CASE WHEN s_suppkey % 5 = 0 THEN 'Prior' END, s_suppkey::VARCHAR) AS name,
    CASE WHEN s_suppkey % 6 = 0 THEN 'subsidiary' WHEN s_suppkey % 7 = 0 THEN 'defunct' ELSE 'independent' END AS status FROM supplier""",
)
def merge_company(t):
    k = F.col("s_suppkey")
    name = F.coalesce(F.when(k % 2 == 0, F.col("s_name")), F.when(k % 3 == 0, F.lit("Seed")), F.when(k % 5 == 0, F.lit("Prior")), k.cast("string"))
    return t.supplier.select(k.alias("id"), name.alias("name"), F.when(k % 6 == 0, "subsidiary").when(k % 7 == 0, "defunct").otherwise("independent").alias("status"))


@query(
    "carry_over",
    """WITH o AS (SELECT p_partkey AS id, p_name AS title FROM part WHERE p_partkey % 4 <> 0), n AS (SELECT p_partkey AS id, upper(p_name) AS title, p_partkey % 6 = 0 AS failed FROM part WHERE p_partkey % 5 <> 0)
    SELECT id, CASE WHEN n.id IS NULL OR (n.failed AND o.id IS NOT NULL) THEN o.title ELSE n.title END AS title, CASE WHEN n.id IS NULL OR (n.failed AND o.id IS NOT NULL) THEN 'prior' ELSE 'new' END AS origin FROM o FULL JOIN n USING (id)""",
)
def carry_over(t):
    k = F.col("p_partkey")
    prior = t.part.where(k % 4 != 0).select(k.alias("id"), F.col("p_name").alias("old"), F.lit(True).alias("known"))
    new = t.part.where(k % 5 != 0).select(k.alias("id"), F.upper("p_name").alias("now"), (k % 6 == 0).alias("failed"))
    both = prior.join(new, "id", "full")
    keep = F.col("failed").isNull() | (F.col("failed") & F.coalesce("known", F.lit(False)))
    return both.select("id", F.when(keep, F.col("old")).otherwise(F.col("now")).alias("title"), F.when(keep, "prior").otherwise("new").alias("origin"))


@query("left_default", "SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END, 'supplier ' || l_suppkey) AS name FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 4 <> 0) ON s_suppkey = l_suppkey")
def left_default(t):
    k = F.col("s_suppkey")
    s = t.supplier.where(k % 4 != 0).select(k.alias("l_suppkey"), F.when(k % 3 != 0, F.col("s_name")).alias("s_name"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(s, "l_suppkey", "left").select("l_orderkey", "l_linenumber", F.coalesce("s_name", F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string"))).alias("name"))


@query("hints_union", "SELECT s_suppkey AS company, 'seed' AS origin FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT l_suppkey, 'provider' FROM lineitem UNION ALL SELECT s_suppkey, 'previous' FROM supplier")
def hints_union(t):
    s = F.col("s_suppkey").alias("company")
    return t.supplier.where("s_suppkey % 2 = 0").select(s, F.lit("seed").alias("origin")).unionByName(t.lineitem.select(F.col("l_suppkey").alias("company"), F.lit("provider").alias("origin"))).unionByName(t.supplier.select(s, F.lit("previous").alias("origin")))


@query("array_patch", "SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN p_type || '|new' ELSE p_type || '|' || p_brand || '|new' END AS tags FROM part")
def array_patch(t):
    tags = F.array_except(F.array_distinct(F.concat(F.array("p_type", "p_brand"), F.array(F.lit("new"), F.col("p_type")))), F.when(F.col("p_size") % 2 == 0, F.array("p_brand")).otherwise(F.expr("cast(array() as array<string>)")))
    return t.part.select(F.col("p_partkey").alias("id"), F.array_join(tags, "|").alias("tags"))


@query("array_overlap", "SELECT l_orderkey, list_has_any(list(l_suppkey) FILTER (l_linenumber <= 2), list(l_suppkey) FILTER (l_linenumber > 2)) AS overlap FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_linenumber > 2) > 0 AND count(*) FILTER (l_linenumber <= 2) > 0")
def array_overlap(t):
    low = F.col("l_linenumber") <= 2
    d = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.when(low, F.col("l_suppkey"))).alias("a"), F.collect_set(F.when(~low, F.col("l_suppkey"))).alias("b"))
    return d.where((F.size("a") > 0) & (F.size("b") > 0)).select("l_orderkey", F.arrays_overlap("a", "b").alias("overlap"))


@query(
    "status_ladder",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'upcoming' WHEN o_orderkey % 7 = 0 THEN 'early-access' WHEN o_orderkey % 11 <> 0 THEN 'released' ELSE 'unknown' END AS status,
    concat_ws('|', CASE WHEN o_orderkey % 2 = 0 THEN 'windows' END, CASE WHEN o_orderkey % 3 = 0 THEN 'macos' END, CASE WHEN o_orderkey % 5 = 0 THEN 'linux' END) AS platforms FROM orders""",
)
def status_ladder(t):
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "P", "upcoming").when(k % 7 == 0, "early-access").when(k % 11 != 0, "released").otherwise("unknown")
    platforms = F.array_compact(F.array(*(F.when(k % n == 0, F.lit(p)) for n, p in ((2, "windows"), (3, "macos"), (5, "linux")))))
    return t.orders.select(k.alias("id"), status.alias("status"), F.array_join(platforms, "|").alias("platforms"))


@query(
    "social_links",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'https://social.example/user' || c_custkey END AS handle, CASE WHEN c_custkey % 3 = 0 THEN 'https://m' || c_nationkey || '.example/@u' || c_custkey END AS mastodon FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0""",
)
def social_links(t):
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit("@u"), k.cast("string"), F.lit("@m"), F.col("c_nationkey").cast("string"), F.lit(".example")))
    pattern = r"^@?([^@]+)@([^@]+)$"
    mastodon = F.when(raw.rlike(pattern), F.concat(F.lit("https://"), F.regexp_extract(raw, pattern, 2), F.lit("/@"), F.regexp_extract(raw, pattern, 1)))
    handle = F.when(k % 2 == 0, F.concat(F.lit("https://social.example/user"), k.cast("string")))
    return t.customer.select(k.alias("id"), handle.alias("handle"), mastodon.alias("mastodon")).where("handle is not null or mastodon is not null")


@query(
    "policy_switch",
    """SELECT p_partkey AS id, policy, CASE WHEN policy <> 'metadata only' THEN p_type END AS description, CASE WHEN policy = 'everything' THEN p_brand END AS media, p_name AS title
    FROM part, (VALUES ('metadata only'), ('descriptions'), ('everything')) AS v(policy)""",
)
def policy_switch(t):
    """What each policy lets through: descriptions and media are null where it doesn't."""
    rules = (("metadata only", False, False), ("descriptions", True, False), ("everything", True, True))
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("policy"), F.lit(d).alias("d"), F.lit(m).alias("m")) for p, d, m in rules)))
    rows = t.part.select("p_partkey", "p_name", "p_type", "p_brand", each.alias("x"))
    return rows.select(F.col("p_partkey").alias("id"), "x.policy", F.when(F.col("x.d"), F.col("p_type")).alias("description"), F.when(F.col("x.m"), F.col("p_brand")).alias("media"), F.col("p_name").alias("title"))


@query("parent_choice", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey::BIGINT WHEN s_suppkey % 3 = 0 THEN s_suppkey + 1 END AS parent FROM supplier")
def parent_choice(t):
    k = F.col("s_suppkey")
    owners = F.when(k % 3 == 0, F.array(k, k + 1, k + 2)).otherwise(F.array(k))
    return t.supplier.select(k.alias("id"), F.coalesce(F.when(k % 4 == 0, F.col("s_nationkey").cast("long")), F.get(F.filter(owners, lambda o: o != k), 0)).alias("parent"))


@query("review_percentages", "SELECT l_partkey AS id, floor(count(*) FILTER (l_returnflag = 'N')::DOUBLE / count(*) * 1000.0 + 0.5) / 10.0 AS positive, floor(count(*) FILTER (l_returnflag <> 'N')::DOUBLE / count(*) * 1000.0 + 0.5) / 10.0 AS negative FROM lineitem GROUP BY 1")
def review_percentages(t):
    good = F.count_if(F.col("l_returnflag") == "N")
    pct = lambda n: F.floor(n / F.count("*") * 1000 + 0.5) / 10
    return t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(pct(good).alias("positive"), pct(F.count("*") - good).alias("negative"))


