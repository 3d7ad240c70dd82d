"""Relational curation: inclusion, clean-up, inverse keys, the edge list and its checks."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.operators.core import components, first_by, inclusion, last_wins, shared_folder
from ferrule.operators.enrichment import enrich
from ferrule.operators.rules import Rule, check
from ferrule.plans.base import query
from ferrule.sources.provider import fetch_fixture, write_fixture

CURATED = "s_suppkey % 7 = 0"


@query("inclusion_semi", f"SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE {CURATED}) OR p_partkey % 100 = 0")
def inclusion_semi(t):
    edges = t.lineitem.select("l_partkey", "l_suppkey").withColumnsRenamed({"l_partkey": "p_partkey", "l_suppkey": "s_suppkey"})
    chosen = inclusion(t.part.select("p_partkey"), "p_partkey", edges, t.supplier.where(CURATED), "s_suppkey")
    return chosen.union(t.part.where("p_partkey % 100 = 0").select("p_partkey")).distinct()


@query("orphan_anti", "SELECT doc_id FROM documents WHERE doc_id % 7 <> 0 AND NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def orphan_anti(t):
    # neither curated nor referenced
    return t.documents.where("doc_id % 7 <> 0").select("doc_id").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@query("reference_cleanup", "SELECT l_orderkey, string_agg(DISTINCT l_suppkey::VARCHAR, '|' ORDER BY l_suppkey::VARCHAR) AS suppliers FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 6 <> 0) GROUP BY 1")
def reference_cleanup(t):
    refs = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    kept = refs.join(t.supplier.where("s_suppkey % 6 <> 0").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey", "left_semi")
    return kept.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), "|").alias("suppliers"))


@query("inverse_fk", "SELECT l_suppkey AS company, count(DISTINCT l_partkey) FILTER (l_linenumber % 2 = 1)::BIGINT AS developed, count(DISTINCT l_partkey) FILTER (l_linenumber % 2 = 0)::BIGINT AS published FROM lineitem GROUP BY 1")
def inverse_fk(t):
    odd = F.col("l_linenumber") % 2 == 1
    pairs = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.max(odd.cast("int")).alias("d"), F.max((~odd).cast("int")).alias("p"))
    return pairs.groupBy(F.col("l_suppkey").alias("company")).agg(F.sum("d").alias("developed"), F.sum("p").alias("published"))


@query("reciprocal_edges", "SELECT a, b FROM (SELECT l_partkey AS a, l_suppkey AS b FROM lineitem UNION SELECT l_suppkey, l_partkey FROM lineitem) WHERE a <> b")
def reciprocal_edges(t):
    e = t.lineitem.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    return e.union(e.select("b", "a")).where("a <> b").distinct()


EDGES = """e AS (SELECT 'c' || l_suppkey AS "from", CASE l_linenumber % 2 WHEN 1 THEN 'developer' ELSE 'publisher' END AS type, 'g' || l_partkey AS "to", 1 AS step, max(l_orderkey) AS source, false AS remove FROM lineitem GROUP BY 1, 2, 3
  UNION ALL SELECT 'g' || p_partkey, (['uses-engine', 'uses-middleware', 'uses-language', 'uses-tool'])[1 + p_partkey % 4], p_brand, 2, p_partkey, false FROM part
  UNION ALL SELECT 'g' || p_partkey, (['dlc-of', 'remaster-of', 'port-of'])[1 + p_partkey % 3], 'g' || (p_partkey - 1), 3, p_partkey, false FROM part WHERE p_partkey % 10 = 1
  UNION ALL SELECT 'c' || s_suppkey, 'subsidiary-of', 'n' || s_nationkey, 4, s_suppkey, false FROM supplier
  UNION ALL SELECT 'u' || c_custkey, 'affiliated-with', 'n' || c_nationkey, 5, NULL, false FROM customer UNION ALL SELECT DISTINCT 'u' || o_custkey, 'credited-on', 'g' || (o_orderkey % 100), 6, NULL::BIGINT, false FROM orders
  UNION ALL SELECT 'c' || s_suppkey, 'developer', 'g' || s_suppkey, 7, -1, s_suppkey % 7 = 0 FROM supplier UNION ALL SELECT 'c' || s_suppkey, CASE s_suppkey % 2 WHEN 0 THEN 'porting' ELSE 'support' END, 'g' || s_suppkey, 7, -1, false FROM supplier)"""


def edges(t):
    """All edges (from, type, to) with their source, in the order in which later ones replace earlier ones; those by hand
    come last and may remove."""
    s, p = F.col("s_suppkey"), F.col("p_partkey")
    pick = lambda column, *names: F.get(F.array(*(F.lit(n) for n in names)), (column % len(names)).cast("int"))
    key = lambda letter, column: F.concat(F.lit(letter), column.cast("string"))

    def edge(rows, step, start, kind, end, source, remove=None):
        return rows.select(start.alias("from"), kind.alias("type"), end.alias("to"), source.cast("long").alias("source"), F.lit(step).alias("step"), (F.lit(False) if remove is None else remove).alias("remove"))

    role = F.when(F.col("l_linenumber") % 2 == 1, "developer").otherwise("publisher")
    credits = t.lineitem.groupBy("l_suppkey", role.alias("role"), "l_partkey").agg(F.max("l_orderkey").alias("source"))
    none, manual = F.lit(None), F.lit(-1)
    return functools.reduce(DataFrame.unionByName, [
        edge(credits, 1, key("c", F.col("l_suppkey")), F.col("role"), key("g", F.col("l_partkey")), F.col("source")),
        edge(t.part, 2, key("g", p), pick(p, "uses-engine", "uses-middleware", "uses-language", "uses-tool"), F.col("p_brand"), p),
        edge(t.part.where(p % 10 == 1), 3, key("g", p), pick(p, "dlc-of", "remaster-of", "port-of"), key("g", p - 1), p),
        edge(t.supplier, 4, key("c", s), F.lit("subsidiary-of"), key("n", F.col("s_nationkey")), s),
        edge(t.customer, 5, key("u", F.col("c_custkey")), F.lit("affiliated-with"), key("n", F.col("c_nationkey")), none),
        edge(t.orders.select("o_custkey", (F.col("o_orderkey") % 100).alias("game")).distinct(), 6, key("u", F.col("o_custkey")), F.lit("credited-on"), key("g", F.col("game")), none),
        edge(t.supplier, 7, key("c", s), F.lit("developer"), key("g", s), manual, s % 7 == 0),
        edge(t.supplier, 7, key("c", s), pick(s, "porting", "support"), key("g", s), manual),
    ])


@query("relationship_graph", f"""WITH {EDGES} SELECT "from" || ':' || type || ':' || "to" AS id, source FROM (SELECT *, row_number() OVER (PARTITION BY "from", type, "to" ORDER BY step DESC) AS n FROM e) WHERE n = 1 AND NOT remove""")
def relationship_graph(t):
    return last_wins(edges(t), ["from", "type", "to"], "step").where("not remove").select(F.concat_ws(":", "from", "type", "to").alias("id"), "source")


@query("edge_type_counts", f"WITH {EDGES} SELECT type, count(*)::BIGINT AS n FROM e GROUP BY 1")
def edge_type_counts(t):
    return edges(t).groupBy("type").agg(F.count("*").alias("n"))


@query(
    "external_id_clusters",
    """WITH n AS (SELECT 'p' || p_partkey AS node, p_partkey // 6 AS block FROM part UNION SELECT 's' || (p_partkey - p_partkey % 2), p_partkey // 6 FROM part UNION SELECT 'w' || (p_partkey - p_partkey % 3), p_partkey // 6 FROM part)
    SELECT node, min(node) OVER (PARTITION BY block) AS root FROM n""",
)
def external_id_clusters(t):
    # a record has an id that two neighbours share and one that three share, so that six records make a cluster
    k = F.col("p_partkey")
    ids = t.part.select(F.concat(F.lit("p"), k.cast("string")).alias("a"), F.explode(F.array(F.concat(F.lit("s"), (k - k % 2).cast("string")), F.concat(F.lit("w"), (k - k % 3).cast("string")))).alias("b"))
    return components(ids)


@query("cluster_id_set", "SELECT l_orderkey % 500 AS cluster, min(l_partkey)::BIGINT AS steam, min('Q' || l_suppkey) AS wikidata FROM lineitem GROUP BY 1")
def cluster_id_set(t):
    return t.lineitem.groupBy((F.col("l_orderkey") % 500).alias("cluster")).agg(F.min(F.col("l_partkey").cast("string").cast("long")).alias("steam"), F.min(F.concat(F.lit("Q"), F.col("l_suppkey").cast("string"))).alias("wikidata"))


@query(
    "integrity_violations",
    """SELECT 'lineitem.part' AS fk, l_partkey AS key, count(*)::BIGINT AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 50 <> 0) GROUP BY 2
    UNION ALL SELECT 'lineitem.supplier', l_suppkey, count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 25 <> 0) GROUP BY 2
    UNION ALL SELECT 'orders.customer', o_custkey, count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 40 <> 0) GROUP BY 2""",
)
def integrity_violations(t):
    checks = (("lineitem.part", t.lineitem, "l_partkey", t.part.where("p_partkey % 50 <> 0"), "p_partkey"), ("lineitem.supplier", t.lineitem, "l_suppkey", t.supplier.where("s_suppkey % 25 <> 0"), "s_suppkey"), ("orders.customer", t.orders, "o_custkey", t.customer.where("c_custkey % 40 <> 0"), "c_custkey"))
    out = None
    for name, rows, fk, targets, key in checks:
        # keys are counted before the anti-join, so that it sees each key once
        bad = rows.groupBy(F.col(fk).alias("key")).agg(F.count("*").alias("n")).join(targets.select(F.col(key).alias("key")), "key", "left_anti").select(F.lit(name).alias("fk"), "key", "n")
        out = bad if out is None else out.unionByName(bad)
    return out


@query("duplicate_ids", "SELECT p_name AS name, count(*)::BIGINT AS n, count(DISTINCT p_brand)::BIGINT AS owners FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(t):
    return t.part.groupBy(F.col("p_name").alias("name")).agg(F.count("*").alias("n"), F.size(F.collect_set("p_brand")).cast("long").alias("owners")).where("n > 1")


@query(
    "constraint_report",
    """SELECT o_orderkey AS id, concat_ws('|', CASE WHEN o_totalprice <= 1000 THEN 'price: too low' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status: not allowed' END, CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-3]-') THEN 'priority: bad form' END) AS messages
    FROM orders WHERE o_totalprice <= 1000 OR o_orderstatus NOT IN ('F', 'O') OR NOT regexp_matches(o_orderpriority, '^[1-3]-')""",
)
def constraint_report(t):
    rules = ((F.col("o_totalprice") > 1000, "price: too low"), (F.col("o_orderstatus").isin("F", "O"), "status: not allowed"), (F.col("o_orderpriority").rlike("^[1-3]-"), "priority: bad form"))
    messages = F.array_compact(F.array(*(F.when(~ok, F.lit(m)) for ok, m in rules)))
    return t.orders.select(F.col("o_orderkey").alias("id"), F.array_join(messages, "|").alias("messages")).where("messages <> ''")


@query("mapping_targets", "SELECT DISTINCT l_suppkey AS target FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)")
def mapping_targets(t):
    return t.lineitem.select(F.col("l_suppkey").alias("target")).distinct().join(t.supplier.where("s_nationkey < 12").select(F.col("s_suppkey").alias("target")), "target", "left_anti")


@query(
    "validation_summary",
    """SELECT 'error' AS level, 'order without lines' AS message, count(*)::BIGINT AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'error', 'supplier below zero', count(*) FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT 'warning', 'small part', count(*) FROM part WHERE p_size < 3""",
)
def validation_summary(t):
    orders = t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    checks = (("error", "order without lines", orders), ("error", "supplier below zero", t.supplier.where("s_acctbal < 0")), ("warning", "small part", t.part.where("p_size < 3")))
    out = None
    for level, message, rows in checks:
        one = rows.agg(F.count("*").alias("n")).select(F.lit(level).alias("level"), F.lit(message).alias("message"), "n")
        out = one if out is None else out.unionByName(one)
    return out


RULES = {
    "page": [Rule("url", "pattern", "^https?://[a-z.]+/[a-z]+/"), Rule("links[]", "pattern", "^/[A-Za-z]+$", level="warning")],
    "event": [Rule("user", "reference", "customer"), Rule("props{}", "most", 90, level="warning"), Rule("type", "among", ("click", "view", "purchase", "login"))],
    "supplier": [Rule("name", "required"), Rule("nation", "reference", "nation")],
    "part": [Rule("name", "exclusive", ("part name", "plain"))],
    "edge": [Rule("to.id", "reference", by="kind")],
}
#: The entities that count, by kind, with their key.
KNOWN = {"part": ("p_partkey", "p_size <= 45"), "supplier": ("s_suppkey", "s_acctbal >= 0"), "customer": ("c_custkey", "c_acctbal >= 0"), "nation": ("n_nationkey", "n_regionkey < 4")}
KNOWN_SQL = " UNION ALL ".join(f"SELECT '{kind}' AS kind, {key}::VARCHAR AS key FROM {kind} WHERE {has}" for kind, (key, has) in KNOWN.items())
EDGE = "CASE l_returnflag WHEN 'A' THEN 'part' WHEN 'R' THEN 'supplier' ELSE 'nation' END"
HREF = 'href="([^"]*)"'


@query(
    "rule_report",
    f"""WITH known AS ({KNOWN_SQL}),
    p AS (SELECT page_id::VARCHAR AS id, unnest(regexp_extract_all(html, '{HREF}', 1)) AS link, generate_subscripts(regexp_extract_all(html, '{HREF}', 1), 1) - 1 AS i FROM pages),
    edges AS (SELECT l_orderkey || '-' || l_linenumber AS id, {EDGE} AS kind, (CASE l_returnflag WHEN 'A' THEN l_partkey WHEN 'R' THEN l_suppkey ELSE l_quantity::BIGINT END)::VARCHAR AS key FROM lineitem),
    shared AS (SELECT p_name, min(p_partkey::VARCHAR) AS a, max(p_partkey::VARCHAR) AS b FROM part WHERE p_size <= 45 GROUP BY 1 HAVING count(*) > 1)
    SELECT 'error' AS level, 'page' AS kind, page_id::VARCHAR AS id, 'url' AS path, 'doesn''t match ^https?://[a-z.]+/[a-z]+/' AS message FROM pages WHERE NOT regexp_matches(url, '^https?://[a-z.]+/[a-z]+/')
    UNION ALL SELECT 'warning', 'page', id, 'links[' || i || ']', 'doesn''t match ^/[A-Za-z]+$' FROM p WHERE NOT regexp_matches(link, '^/[A-Za-z]+$')
    UNION ALL SELECT 'error', 'event', event_id::VARCHAR, 'user', 'unknown customer ' || user_id FROM events WHERE user_id::VARCHAR NOT IN (SELECT key FROM known WHERE kind = 'customer')
    UNION ALL SELECT 'warning', 'event', event_id::VARCHAR, 'props.k', 'is above 90' FROM events WHERE (props ->> '$.k')::INT > 90
    UNION ALL SELECT 'error', 'event', event_id::VARCHAR, 'type', 'is none of click, view, purchase, login' FROM events WHERE event_type NOT IN ('click', 'view', 'purchase', 'login')
    UNION ALL SELECT 'error', 'supplier', s_suppkey::VARCHAR, 'nation', 'unknown nation ' || s_nationkey FROM supplier WHERE s_acctbal >= 0 AND s_nationkey::VARCHAR NOT IN (SELECT key FROM known WHERE kind = 'nation')
    UNION ALL SELECT 'error', 'part', p_partkey::VARCHAR, 'name', chr(39) || p_name || chr(39) || ' is used from part ' || a || ' to part ' || b FROM part JOIN shared USING (p_name) WHERE p_size <= 45
    UNION ALL SELECT 'error', 'edge', e.id, 'to.id', 'unknown ' || e.kind || ' ' || e.key FROM edges AS e LEFT JOIN known AS k ON k.kind = e.kind AND k.key = e.key WHERE k.key IS NULL
    UNION ALL SELECT 'error', 'edge', id, 'id', count(*) || ' rows of one id' FROM edges GROUP BY id HAVING count(*) > 1""",
)
def rule_report(t):
    # links are nested items, properties a map; edges name the kind of their end, and some ends are left out of the tables
    tables = {kind: getattr(t, kind).where(has).withColumn("id", F.col(key)) for kind, (key, has) in KNOWN.items()}
    tables["part"] = tables["part"].withColumn("name", F.col("p_name"))
    tables["supplier"] = tables["supplier"].select("id", F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    tables["page"] = t.pages.select(F.col("page_id").alias("id"), "url", F.regexp_extract_all("html", F.lit(HREF), 1).alias("links"))
    tables["event"] = t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("user"), F.from_json("props", "map<string,int>").alias("props"), F.col("event_type").alias("type"))
    end = F.when(F.col("l_returnflag") == "A", F.col("l_partkey")).when(F.col("l_returnflag") == "R", F.col("l_suppkey")).otherwise(F.col("l_quantity").cast("long"))
    tables["edge"] = t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.struct(F.expr(EDGE).alias("kind"), end.alias("id")).alias("to"))
    return check(tables, RULES)


#: What entries may set, and what is computed and must not be set.
EDITABLE, COMPUTED = ("click", "view", "login"), ("purchase",)


@query(
    "override_lint",
    f"""WITH e AS (SELECT user_id AS entry, event_type || CASE WHEN event_id % 3 = 0 THEN '.value' ELSE '' END AS path FROM events)
    SELECT split_part(path, '.', 1) AS field, CASE WHEN split_part(path, '.', 1) IN {(*COMPUTED, "")} THEN 'computed field' ELSE 'unknown field' END AS problem, count(*)::BIGINT AS entries, count(DISTINCT entry)::BIGINT AS subjects
    FROM e WHERE split_part(path, '.', 1) NOT IN {EDITABLE} GROUP BY 1""",
)
def override_lint(t):
    # every entry sets a dot path, of which the first part is the field
    entries = t.events.select(F.col("user_id").alias("entry"), F.concat("event_type", F.when(F.col("event_id") % 3 == 0, ".value").otherwise("")).alias("path"))
    bad = entries.select("entry", F.element_at(F.split("path", r"\."), 1).alias("field")).where(~F.col("field").isin(*EDITABLE))
    subjects = bad.groupBy("field", "entry").agg(F.count("*").alias("n")).groupBy("field").agg(F.sum("n").alias("entries"), F.count("*").alias("subjects"))
    return subjects.select("field", F.when(F.col("field").isin(*COMPUTED), "computed field").otherwise("unknown field").alias("problem"), "entries", "subjects")


CLAIMS = """c AS (SELECT DISTINCT p_partkey AS game, p_brand AS tech, CASE WHEN p_size < 25 THEN 'low' ELSE 'medium' END AS confidence FROM part)"""


@query(
    "claim_overrides",
    f"""WITH {CLAIMS} SELECT game, tech, confidence FROM c WHERE game % 6 NOT IN (0, 1) UNION ALL SELECT game, tech, 'verified' FROM c WHERE game % 6 = 1""",
)
def claim_overrides(t):
    claims = t.part.select(F.col("p_partkey").alias("game"), F.col("p_brand").alias("tech"), F.when(F.col("p_size") < 25, "low").otherwise("medium").alias("confidence")).distinct()
    entries = t.part.where("p_partkey % 6 in (0, 1)").select(F.col("p_partkey").alias("game"), F.col("p_brand").alias("tech"), (F.col("p_partkey") % 6 == 0).alias("remove")).distinct()
    kept = claims.join(entries, ["game", "tech"], "left_anti")
    return kept.unionByName(entries.where("not remove").select("game", "tech", F.lit("verified").alias("confidence")))


@query(
    "relationship_overrides",
    """WITH o AS (SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'developer' WHEN 1 THEN 'subsidiary-of' WHEN 2 THEN 'porting' ELSE 'support' END AS type FROM supplier)
    SELECT id, type, CASE WHEN type IN ('developer', 'subsidiary-of') THEN 'entity' ELSE 'edge' END AS route FROM o""",
)
def relationship_overrides(t):
    kinds = F.array(*(F.lit(x) for x in ("developer", "subsidiary-of", "porting", "support")))
    structural = ("developer", "publisher", "subsidiary-of", "dlc-of", "remaster-of", "port-of", "uses-engine", "uses-middleware", "uses-language", "uses-tool")
    o = t.supplier.select(F.col("s_suppkey").alias("id"), F.get(kinds, (F.col("s_suppkey") % 4).cast("int")).alias("type"))
    return o.withColumn("route", F.when(F.col("type").isin(*structural), "entity").otherwise("edge"))


@query("role_order", "SELECT l_suppkey AS company, concat_ws('|', CASE WHEN bool_or(l_linenumber % 3 = 0) THEN 'developer' END, CASE WHEN bool_or(l_linenumber % 3 = 1) THEN 'publisher' END, CASE WHEN bool_or(l_linenumber % 3 = 2) THEN 'porting' END) AS roles FROM lineitem GROUP BY 1")
def role_order(t):
    names = F.array(*(F.lit(x) for x in ("developer", "publisher", "porting")))
    has = t.lineitem.groupBy(F.col("l_suppkey").alias("company")).agg(F.collect_set(F.get(names, (F.col("l_linenumber") % 3).cast("int"))).alias("own"))
    return has.select("company", F.array_join(F.filter(names, lambda r: F.array_contains("own", r)), "|").alias("roles"))


@query("parent_by_name", "SELECT a.s_suppkey AS child, b.s_suppkey AS parent FROM supplier AS a JOIN (SELECT s_nationkey, max(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1) AS b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey")
def parent_by_name(t):
    parents = t.supplier.groupBy("s_nationkey").agg(F.max("s_suppkey").alias("parent"))
    return t.supplier.join(parents, "s_nationkey").where("s_suppkey <> parent").select(F.col("s_suppkey").alias("child"), "parent")


@query(
    "enrichment_rounds",
    """WITH m AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem), w0 AS (SELECT DISTINCT p FROM m WHERE p = 1),
    w1 AS (SELECT DISTINCT p FROM m WHERE o IN (SELECT o FROM m WHERE p IN (SELECT p FROM w0))), w2 AS (SELECT DISTINCT p FROM m WHERE o IN (SELECT o FROM m WHERE p IN (SELECT p FROM w1))),
    w3 AS (SELECT DISTINCT p FROM m WHERE o IN (SELECT o FROM m WHERE p IN (SELECT p FROM w2)))
    SELECT p, min(depth)::INT AS depth FROM (SELECT p, 0 AS depth FROM w0 UNION ALL SELECT p, 1 FROM w1 UNION ALL SELECT p, 2 FROM w2 UNION ALL SELECT p, 3 FROM w3) GROUP BY 1""",
)
def enrichment_rounds(t, rounds: int = 3):
    m = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p")).distinct()
    known = m.where("p = 1").select("p").distinct().withColumn("depth", F.lit(0))
    frontier = known
    for depth in range(1, rounds + 1):
        near = frontier.select("p").join(m, "p").select("o").distinct().join(m, "o").select("p").distinct()
        frontier = near.join(known, "p", "left_anti").withColumn("depth", F.lit(depth))
        known = known.unionByName(frontier)
    return known


@query(
    "provider_enrichment",
    """WITH RECURSIVE rec AS (SELECT p_partkey AS k, CASE WHEN p_size > 25 THEN 'store' ELSE 'database' END AS provider, 's' || (p_partkey // 2) AS a, 'w' || (p_partkey // 3) AS b, p_name AS record FROM part),
    ids AS (SELECT k, a AS id FROM rec UNION ALL SELECT k, b FROM rec),
    reach AS (SELECT DISTINCT 's' || (p_partkey // 2) AS id FROM part WHERE p_size <= 3 UNION SELECT other.id FROM reach JOIN ids AS mine ON mine.id = reach.id JOIN ids AS other ON other.k = mine.k)
    SELECT provider, a || '|' || b AS ids, max(record) AS record, 'fetched' AS state FROM rec WHERE a IN (SELECT id FROM reach) OR b IN (SELECT id FROM reach) GROUP BY 1, 2
    UNION ALL SELECT 'press', 's' || s_suppkey, s_name, 'carried' FROM supplier
    UNION ALL SELECT * FROM (VALUES ('store', '', '', 'ok'), ('database', '', '', 'ok'), ('press', '', '', 'error'))""",
)
def provider_enrichment(t):
    # two providers hold the parts, each with an id that two neighbours share and one that three share; a third one has nothing
    # at its place and is carried over
    folder = shared_folder(t.spark)
    ids = F.array(F.concat(F.lit("s"), F.expr("p_partkey div 2").cast("string")), F.concat(F.lit("w"), F.expr("p_partkey div 3").cast("string")))
    records = t.part.select((F.col("p_size") > 25).alias("store"), ids.alias("ids"), F.col("p_name").alias("record"))
    write_fixture(records.where("store"), f"{folder}/store")
    write_fixture(records.where("not store"), f"{folder}/database")
    providers = {n: functools.partial(fetch_fixture, t.spark, f"{folder}/{n}") for n in ("store", "database", "press")}
    seeds = t.part.where("p_size <= 3").select(F.get(ids, 0).alias("id"))
    earlier = t.supplier.select(F.lit("press").alias("provider"), F.array(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))).alias("ids"), F.col("s_name").alias("record"))
    got, status = enrich(t.spark, seeds, providers, earlier)
    return got.select("provider", F.array_join("ids", "|").alias("ids"), "record", "state").unionByName(status.select("provider", F.lit("").alias("ids"), F.lit("").alias("record"), F.col("status").alias("state")))


@query("affiliations", "SELECT c_nationkey AS company, c_custkey AS person FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)")
def affiliations(t):
    return t.customer.join(t.supplier.select(F.col("s_nationkey").alias("c_nationkey")), "c_nationkey", "left_semi").select(F.col("c_nationkey").alias("company"), F.col("c_custkey").alias("person"))


@query("first_external_id", "SELECT l_partkey AS game, arg_min(l_suppkey, l_linenumber * 1000000 + l_orderkey) AS id FROM lineitem GROUP BY 1")
def first_external_id(t):
    # the place is one number, in which high order keys run into the next line; a part without a place or id has a null one
    place = F.col("l_linenumber").cast("long") * 1_000_000 + F.col("l_orderkey")
    rows = t.lineitem.select("l_partkey", "l_suppkey", place.alias("place"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    # of rows in one place the SQL keeps the first it reads: files by name, rows as they stand in them
    least = F.min(F.when(F.col("l_suppkey").isNotNull() & F.col("place").isNotNull(), F.struct("place", "file", "row", "l_suppkey")))
    return rows.groupBy(F.col("l_partkey").alias("game")).agg(least["l_suppkey"].alias("id"))
