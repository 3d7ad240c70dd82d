"""Entity resolution: evidence in order, folding of names, canonical ids, issues."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.functions import columns as C
from ferrule.operators.core import first_by
from ferrule.operators.ids import stable_ids
from ferrule.operators.resolver import PROVIDERS, evidence, learn, resolve, resolve_all, similar_names
from ferrule.plans.base import query


@query(
    "canonical_ids",
    """WITH RECURSIVE s AS (SELECT p_partkey AS root, replace(p_name, ' ', '-') AS slug, p_size, p_partkey % 20 = 3 AS registered, p_partkey % 50 = 7 AS mapped FROM part),
    taken AS (SELECT slug, list(DISTINCT id) AS ids FROM (SELECT slug, slug || '-' || p_size AS id FROM s WHERE registered UNION SELECT slug, 'mapped-' || root FROM s WHERE mapped) GROUP BY 1),
    c AS (SELECT root, slug, slug || '-' || p_size AS dated, row_number() OVER (PARTITION BY slug ORDER BY root) AS k FROM s WHERE NOT registered AND NOT mapped),
    t AS (SELECT DISTINCT s.slug, 0::BIGINT AS k, NULL::BIGINT AS root, NULL::VARCHAR AS id, coalesce(ids, []) AS ids FROM s LEFT JOIN taken USING (slug)
      UNION ALL SELECT slug, k, root, id, list_append(ids, id) FROM (SELECT t.slug, c.k, c.root, t.ids, CASE WHEN NOT list_contains(t.ids, t.slug) THEN t.slug WHEN NOT list_contains(t.ids, dated) THEN dated
          ELSE t.slug || '-' || list_min(list_filter(range(2, len(t.ids) + 3), lambda n: NOT list_contains(t.ids, t.slug || '-' || n))) END AS id FROM t JOIN c ON c.slug = t.slug AND c.k = t.k + 1))
    SELECT root, id FROM t WHERE k > 0 UNION ALL SELECT root, CASE WHEN mapped THEN 'mapped-' || root ELSE slug || '-' || p_size END FROM s WHERE registered OR mapped""",
)
def canonical_ids(t):
    """A mapped id, else the registered one, else the first of name, name with size and name with a counter that is free."""
    k, slug = F.col("p_partkey"), C.slug(F.col("p_name"))
    key, dated = F.concat(F.lit("steam:"), k.cast("string")), F.concat_ws("-", slug, F.col("p_size").cast("string"))
    clusters = t.part.select(k.alias("key"), F.array(key).alias("ids"), F.array(slug, dated).alias("candidates"))
    mapped = t.part.where(k % 50 == 7).select(key.alias("key"), F.concat(F.lit("mapped-"), k.cast("string")).alias("id"))
    registry = t.part.where(k % 20 == 3).select(key.alias("key"), dated.alias("id"))
    return stable_ids(clusters, mapped, registry, registry.select("id"), "steam:").select(F.col("key").alias("root"), "id")


HOUSES = """h AS (SELECT s_suppkey AS id, 'house ' || s_nationkey AS key FROM supplier)"""


@query("name_match_exact", f"WITH {HOUSES}, d AS (SELECT key, min(id) AS id, count(*)::BIGINT AS candidates FROM h WHERE id % 2 = 0 GROUP BY 1) SELECT h.id AS ref, d.id AS match, candidates FROM h JOIN d USING (key)")
def name_match_exact(t):
    form = F.get(F.array(*(F.lit(x) for x in (" Inc.", " GmbH", ", Co. Ltd", ""))), (F.col("s_suppkey") % 4).cast("int"))
    h = t.supplier.select(F.col("s_suppkey").alias("id"), C.company_name(F.concat(F.lit("House "), F.col("s_nationkey").cast("string"), form)).alias("key"))
    d = h.where("id % 2 = 0").groupBy("key").agg(F.min("id").alias("match"), F.count("*").alias("candidates"))
    return h.join(d, "key").select(F.col("id").alias("ref"), "match", "candidates")


LADDER = """d AS (SELECT s_suppkey AS id, 's' || s_suppkey AS ext, lower(replace(s_name, '#', ' ')) AS key, s_suppkey % 2 = 0 AS seeded FROM supplier WHERE s_suppkey % 3 <> 0),
  r AS (SELECT s_suppkey AS ref, CASE WHEN s_suppkey % 4 = 0 THEN 's' || s_suppkey END AS ext, CASE WHEN s_suppkey % 5 = 0 THEN 'mapped ' || s_suppkey ELSE s_name || ' Inc.' END AS name FROM supplier)"""


@query(
    "evidence_ladder",
    f"""WITH {LADDER}, m AS (SELECT 'mapped ' || s_suppkey AS name, s_suppkey AS id FROM supplier WHERE s_suppkey % 10 = 0)
    SELECT r.ref, coalesce(m.id, e.id, k.id) AS id, CASE WHEN m.id IS NOT NULL THEN 'mapping' WHEN e.id IS NOT NULL THEN 'external-id' WHEN k.id IS NOT NULL THEN 'normalized-name' ELSE 'new' END AS method
    FROM r LEFT JOIN m ON m.name = r.name LEFT JOIN d AS e ON e.ext = r.ext LEFT JOIN d AS k ON k.key || ' inc.' = lower(replace(r.name, '#', ' '))""",
)
def evidence_ladder(t):
    k = F.col("s_suppkey")
    known = t.supplier.where(k % 3 != 0).select(k.alias("id"), F.concat(F.lit("s"), k.cast("string")).alias("ext"), C.company_name(F.col("s_name")).alias("key"))
    refs = t.supplier.select(k.alias("ref"), F.when(k % 4 == 0, F.concat(F.lit("s"), k.cast("string"))).alias("ext"), F.when(k % 5 == 0, F.concat(F.lit("mapped "), k.cast("string"))).otherwise(F.concat("s_name", F.lit(" Inc."))).alias("name"))
    mapping = t.supplier.where(k % 10 == 0).select(F.concat(F.lit("mapped "), k.cast("string")).alias("name"), k.alias("id"))
    steps = [("mapping", mapping.select("id", F.col("name").alias("value")), F.col("name")), ("external-id", known.select("id", F.col("ext").alias("value")), F.col("ext")), ("normalized-name", known.select("id", F.col("key").alias("value")), C.company_name(F.col("name")))]
    return resolve(refs, "ref", steps).select("ref", "id", F.coalesce("method", F.lit("new")).alias("method"))


@query(
    "loose_fold",
    r"""WITH x AS (SELECT s_suppkey AS id, s_nationkey, CASE s_suppkey % 4 WHEN 0 THEN 'house ' || s_nationkey || ' games' WHEN 1 THEN 'house ' || s_nationkey || ' studios' WHEN 2 THEN 'house ' || s_nationkey || ' publishing' ELSE 'house ' || s_nationkey END AS name, s_suppkey % 10 = 0 AS seeded FROM supplier),
    l AS (SELECT *, regexp_replace(name, '( (?:games|studios))+$', '') AS loose FROM x), g AS (SELECT loose, count(*) FILTER (seeded) AS seeds FROM l GROUP BY 1),
    p AS (SELECT l.loose, first(id ORDER BY seeded DESC, length(name), id) AS canonical FROM l JOIN g USING (loose) WHERE seeds < 2 GROUP BY 1)
    SELECT l.id, coalesce(p.canonical, l.id) AS canonical FROM l LEFT JOIN p USING (loose)""",
)
def loose_fold(t):
    k, base = F.col("s_suppkey"), F.concat(F.lit("house "), F.col("s_nationkey").cast("string"))
    name = F.when(k % 4 == 0, F.concat(base, F.lit(" games"))).when(k % 4 == 1, F.concat(base, F.lit(" studios"))).when(k % 4 == 2, F.concat(base, F.lit(" publishing"))).otherwise(base)
    x = t.supplier.select(k.alias("id"), name.alias("name"), (k % 10 == 0).alias("seeded")).withColumn("loose", C.loose_company_name(F.col("name")))
    pick = F.min(F.struct((~F.col("seeded")).alias("a"), F.length("name").alias("b"), "id"))["id"]
    groups = x.groupBy("loose").agg(F.count_if("seeded").alias("seeds"), pick.alias("canonical")).where("seeds < 2").select("loose", "canonical")
    return x.join(groups, "loose", "left").select("id", F.coalesce("canonical", "id").alias("canonical"))


@query(
    "id_conflict_guard",
    """WITH k AS (SELECT s_suppkey AS id, s_nationkey AS name, nullif(s_suppkey % 5, 0) AS ext FROM supplier)
    SELECT r.id AS ref, min(c.id) AS candidate FROM k AS r JOIN k AS c ON r.name = c.name AND r.id % 2 = 1 AND c.id % 2 = 0 WHERE NOT coalesce(r.ext <> c.ext, false) GROUP BY 1""",
)
def id_conflict_guard(t):
    """For each reference the first company of its name whose external id doesn't differ from its own; a missing id
    differs from none. Names meet by their least companies with each id, without one and at all, never pair by pair."""
    k = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("name"), F.nullif(F.col("s_suppkey") % 5, F.lit(0)).alias("ext"))
    least = k.where("id % 2 = 0").groupBy("name", "ext").agg(F.min("id").alias("id"))
    by_name = least.groupBy("name").agg(F.min("id").alias("any"), F.min(F.when(F.col("ext").isNull(), F.col("id"))).alias("without"))
    by_id = least.where("ext is not null").select("name", "ext", F.col("id").alias("same"))
    refs = k.where("id % 2 = 1").join(by_name, "name").join(by_id, ["name", "ext"], "left")
    return refs.select(F.col("id").alias("ref"), F.when(F.col("ext").isNull(), F.col("any")).otherwise(F.least("same", "without")).alias("candidate")).where("candidate is not null")


@query("ambiguous_matches", "SELECT s_nationkey AS key, count(*)::BIGINT AS candidates, coalesce(CASE WHEN count(*) FILTER (s_suppkey % 10 = 0) = 1 THEN min(s_suppkey) FILTER (s_suppkey % 10 = 0) END, min(s_suppkey)) AS chosen FROM supplier GROUP BY 1 HAVING count(*) > 1")
def ambiguous_matches(t):
    seeded = F.col("s_suppkey") % 10 == 0
    g = t.supplier.groupBy(F.col("s_nationkey").alias("key")).agg(F.count("*").alias("candidates"), F.count_if(seeded).alias("seeds"), F.min(F.when(seeded, F.col("s_suppkey"))).alias("seed"), F.min("s_suppkey").alias("least"))
    return g.where("candidates > 1").select("key", "candidates", F.when(F.col("seeds") == 1, F.col("seed")).otherwise(F.col("least")).alias("chosen"))


@query("shared_prefix", "SELECT DISTINCT a.p_name AS name, b.p_name AS longer FROM part AS a JOIN (SELECT DISTINCT p_name || ' ' || p_type AS p_name FROM part) AS b ON starts_with(b.p_name, a.p_name || ' ')")
def shared_prefix(t):
    # every word prefix of the longer names, then an equi-join
    longer = t.part.select(F.concat_ws(" ", "p_name", "p_type").alias("longer")).distinct()
    words = F.split("longer", " ")
    prefixes = longer.select("longer", F.explode(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.array_join(F.slice(words, 1, n), " "))).alias("name"))
    return prefixes.join(t.part.select(F.col("p_name").alias("name")).distinct(), "name").select("name", "longer")


@query("or_join_ids", "SELECT l_orderkey AS a, o_orderkey AS b FROM (SELECT l_orderkey, unnest([l_orderkey, l_partkey, l_suppkey]) AS k FROM lineitem) JOIN orders ON o_orderkey = k GROUP BY 1, 2")
def or_join_ids(t):
    a = t.lineitem.select(F.col("l_orderkey").alias("a"), F.explode(F.array_distinct(F.array("l_orderkey", "l_partkey", "l_suppkey"))).alias("b"))
    return a.join(t.orders.select(F.col("o_orderkey").alias("b")), "b").select("a", "b").distinct()


@query(
    "duplicate_titles",
    """WITH s AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) SELECT DISTINCT a.p_partkey AS a, b.p_partkey AS b FROM part AS a JOIN part AS b ON a.p_name = b.p_name AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey
    JOIN s AS x ON x.l_partkey = a.p_partkey JOIN s AS y ON y.l_partkey = b.p_partkey AND y.l_suppkey = x.l_suppkey WHERE (a.p_partkey + b.p_partkey) % 10 <> 0""",
)
def duplicate_titles(t):
    # the shared supplier is part of the join key, so pairs without one are never made
    s = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_suppkey").distinct().join(t.part.select("p_partkey", C.title_name(F.col("p_name")).alias("title"), "p_type"), "p_partkey")
    a, b = s.withColumnRenamed("p_partkey", "a"), s.withColumnRenamed("p_partkey", "b")
    pairs = a.join(b, ["title", "p_type", "l_suppkey"]).where("a < b").select("a", "b").distinct()
    return pairs.where("(a + b) % 10 <> 0")  # stands for pairs known to be distinct


@query(
    "resolve_technology",
    """SELECT p_partkey AS ref, CASE WHEN p_partkey % 4 = 0 THEN 'id' WHEN p_size < 40 THEN 'name' ELSE 'new' END AS method, CASE WHEN p_partkey % 2 = 0 THEN 'engine' ELSE 'language' END AS category,
    CASE WHEN p_partkey % 4 = 0 OR p_size < 40 THEN replace(lower(p_brand), '#', '-') ELSE 'new-' || replace(lower(p_brand), '#', '-') END AS id FROM part""",
)
def resolve_technology(t):
    k = F.col("p_partkey")
    catalogue = t.part.select("p_brand").distinct().select(F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")).alias("id"), C.technology_name(F.col("p_brand")).alias("key"), F.concat(F.lit("x:"), "p_brand").alias("ext"))
    refs = t.part.select(k.alias("ref"), F.when(k % 4 == 0, F.concat(F.lit("x:"), "p_brand")).alias("ext"), F.when(F.col("p_size") < 40, C.technology_name(F.col("p_brand"))).alias("key"), F.when(k % 2 == 0, "engine").otherwise("language").alias("category"), F.concat(F.lit("new-"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-"))).alias("fresh"))
    found = resolve(refs, "ref", [("id", catalogue.select("id", F.col("ext").alias("value")), F.col("ext")), ("name", catalogue.select("id", F.col("key").alias("value")), F.col("key"))])
    return found.select("ref", F.coalesce("method", F.lit("new")).alias("method"), "category", F.coalesce("id", "fresh").alias("id"))


@query("resolver_learning")
def resolver_learning(t):
    """References by name teach the ids that stand beside them; two rounds at most are needed here."""
    k = F.col("s_suppkey")
    known = t.supplier.select(k.alias("id"), C.company_name(F.col("s_name")).alias("value"))
    refs = t.supplier.select(k.alias("ref"), F.when(k % 2 == 0, C.company_name(F.col("s_name"))).alias("name"), F.concat(F.lit("x"), (k - k % 2).cast("string")).alias("ext"))
    return learn(refs, known).select("ref", "id", "round")


@query(
    "stateful_resolution",
    """SELECT s_suppkey AS ref, CASE WHEN (s_suppkey // 4) % 2 = 0 THEN 'h' || (s_suppkey // 4) ELSE 'hall-' || (s_suppkey // 4) END AS id, (s_suppkey // 4) % 2 = 1 AND s_suppkey % 4 = 0 AS created FROM supplier""",
)
def stateful_resolution(t):
    """Four references in a row know each other by one thing only: an id of one provider, of the next, and a name. Of every
    second four the first is known; of the others it makes a company."""
    k = F.col("s_suppkey")
    group, nth = (k / 4).cast("long"), (k % 4).cast("int")
    of = lambda word: F.concat_ws(" ", F.lit(word), group.cast("string"))
    some = lambda letter, *places: F.when(nth.isin(*places), F.concat(F.lit(letter), group.cast("string")))
    name = F.when(nth == 0, of("Hall")).when(nth == 1, of("Gate")).otherwise(of("Tower"))
    refs = t.supplier.select(k.alias("ref"), name.alias("name"), some("a", 0, 1).alias("steam"), some("b", 1, 2).alias("wikidata"), some("c", 9).alias("igdb"))
    entries = t.supplier.where((group % 2 == 0) & (nth == 0)).select(F.concat(F.lit("h"), group.cast("string")).alias("id"), of("Hall").alias("name"), F.expr("cast(null as array<string>)").alias("aliases"), F.lit(False).alias("seeded"), *(F.lit(None).cast("string").alias(p) for p in PROVIDERS))
    none = lambda shape: t.spark.createDataFrame([], shape)
    found, _ = resolve_all(refs, entries, none("key string, id string"), none("name string, id string"), none("key string, id string"), none("a string, b string"))
    return found.select("ref", "id", "created")


@query("registry_lookup", "SELECT p_partkey AS ref, coalesce(CASE WHEN p_partkey % 9 = 0 THEN p_partkey + 1000000 END, CASE WHEN p_partkey % 4 = 0 THEN p_partkey + 500000 END, CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 100000 END) AS id FROM part")
def registry_lookup(t):
    k = F.col("p_partkey")

    def table(every, add, name):
        return t.part.where(k % every == 0).select(k, (k + add).alias(name))

    out = t.part.select(k)
    for every, add, name in ((9, 1_000_000, "mapped"), (4, 500_000, "registered"), (3, 100_000, "known")):
        out = out.join(table(every, add, name), "p_partkey", "left")
    return out.select(k.alias("ref"), F.coalesce("mapped", "registered", "known").alias("id"))


@query("registry_append", "SELECT key, min(id) AS id FROM (SELECT 'steam:' || p_partkey AS key, p_partkey AS id FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'steam:' || l_partkey, l_suppkey + 100000 FROM lineitem WHERE l_partkey % 2 = 1) GROUP BY 1")
def registry_append(t):
    old = t.part.where("p_partkey % 2 = 0").select(F.concat(F.lit("steam:"), F.col("p_partkey").cast("string")).alias("key"), F.col("p_partkey").alias("id"))
    new = t.lineitem.groupBy(F.concat(F.lit("steam:"), F.col("l_partkey").cast("string")).alias("key")).agg(F.min(F.col("l_suppkey") + 100000).alias("id"))
    return old.unionByName(new.join(old, "key", "left_anti"))


@query("now_linked", "SELECT l_orderkey AS cluster, count(DISTINCT l_suppkey)::BIGINT AS registered, min(l_suppkey) AS kept FROM lineitem WHERE l_suppkey % 4 = 0 GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def now_linked(t):
    g = t.lineitem.where("l_suppkey % 4 = 0").groupBy(F.col("l_orderkey").alias("cluster")).agg(F.size(F.collect_set("l_suppkey")).cast("long").alias("registered"), F.min("l_suppkey").alias("kept"))
    return g.where("registered > 1")


@query("mapped_names", "SELECT s_suppkey AS ref, 'map-' || s_nationkey AS target FROM supplier WHERE s_suppkey % 3 = 0")
def mapped_names(t):
    mapping = t.supplier.where("s_suppkey % 3 = 0").select(C.company_name(F.concat("s_name", F.lit(" GmbH"))).alias("key"), F.concat(F.lit("map-"), F.col("s_nationkey").cast("string")).alias("target"), "s_suppkey")
    first = first_by(mapping, ["key"], [F.col("s_suppkey")]).select("key", "target")
    return t.supplier.select(F.col("s_suppkey").alias("ref"), C.company_name(F.col("s_name")).alias("key")).join(first, "key").select("ref", "target")


@query("seed_suggestions", "SELECT s_nationkey AS seed, min(s_suppkey) AS suggestion FROM supplier WHERE s_acctbal > 5000 GROUP BY 1 HAVING count(*) = 1")
def seed_suggestions(t):
    return t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("seed")).agg(F.count("*").alias("n"), F.min("s_suppkey").alias("suggestion")).where("n = 1").select("seed", "suggestion")


@query("issue_dedup", "SELECT DISTINCT l_returnflag AS kind, l_partkey % 20 AS subject, least(l_suppkey, l_partkey) || '|' || greatest(l_suppkey, l_partkey) AS related FROM lineitem WHERE l_suppkey <> l_partkey")
def issue_dedup(t):
    pair = F.transform(F.array_sort(F.array("l_suppkey", "l_partkey")), lambda x: x.cast("string"))
    return t.lineitem.where("l_suppkey <> l_partkey").select(F.col("l_returnflag").alias("kind"), (F.col("l_partkey") % 20).alias("subject"), F.array_join(pair, "|").alias("related")).dropDuplicates(["kind", "subject", "related"])


def varied_names(t):
    """Names that differ enough: twelve letters for every four suppliers, of which one is whole, one shortened, one has
    two letters swapped and one has a word more."""
    k = F.col("s_suppkey")
    base = F.translate(F.substring(F.md5((k - k % 4).cast("string").cast("binary")), 1, 12), "0123456789", "ghijklmnop")
    swapped = F.concat(F.substring(base, 1, 5), F.substring(base, 7, 1), F.substring(base, 6, 1), F.substring(base, 8, 5))
    name = F.when(k % 4 == 0, base).when(k % 4 == 1, F.substring(base, 2, 11)).when(k % 4 == 2, swapped).otherwise(F.concat(base, F.lit(" Games")))
    return t.supplier.select(k.alias("id"), name.alias("name"))


@query("fuzzy_flags")
def fuzzy_flags(t):
    """Companies whose core names are equal (0.95) or at least 0.93 alike, each pair of companies once. Names meet once
    whatever number of companies share them; then every company of one name meets every company of the other."""
    core = varied_names(t).select("id", C.core_company_name(F.col("name")).alias("core")).distinct()
    # not broadcast: a row for each company
    x, y = (core.select(F.col("core").alias(c), F.col("id").alias(f"{c}_id")).hint("merge") for c in "ab")
    equal = x.join(y, F.col("a") == F.col("b")).where("a_id < b_id").select(F.col("a_id").alias("id"), F.col("b_id").alias("other"), F.lit(0.95).alias("score"))
    pairs = similar_names(core, "core", 0.93)
    found = pairs.join(x, "a").join(y, "b").select(F.least("a_id", "b_id").alias("id"), F.greatest("a_id", "b_id").alias("other"), "score")
    return equal.unionByName(found)


@query("evidence_keys", "SELECT key_type, count(*)::BIGINT AS n FROM (SELECT DISTINCT 'exact' AS key_type, lower(replace(s_name, '#', ' ')) AS k, s_suppkey FROM supplier UNION ALL SELECT DISTINCT 'compact', replace(lower(replace(s_name, '#', ' ')), ' ', ''), s_suppkey FROM supplier UNION ALL SELECT DISTINCT 'loose', lower(replace(s_name, '#', ' ')), s_suppkey FROM supplier) GROUP BY 1")
def evidence_keys(t):
    return evidence(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))).groupBy("key_type").agg(F.count("*").alias("n"))
