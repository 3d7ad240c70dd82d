"""Resolution in full, review candidates of every category, whole diffs and corrections over any shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.operators import overrides, resolver, review
from ferrule.plans.base import query


@query("company_ladder")
def company_ladder(t):
    """Every line's supplier as a reference by name and now and then by id, against two thirds of the suppliers."""
    k, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    text = k.cast("string")
    base = F.concat(F.lit("House "), nation, F.when(k % 5 == 0, F.lit(" Games")).when(k % 5 == 1, F.lit(" Publishing")).when(k % 5 == 2, F.concat(F.lit(" "), text)).otherwise(F.lit("")))
    ids = {"steam": F.when(k % 7 == 0, F.concat(F.lit("s"), text)), "wikidata": F.when(k % 4 == 0, F.concat(F.lit("Q"), text)), "igdb": F.lit(None).cast("string")}
    some = t.supplier.select(k.alias("id"), base.alias("name"), (k % 10 == 3).alias("seeded"), *(v.alias(n) for n, v in ids.items()))
    entries = some.where("id % 3 <> 0").withColumn("aliases", F.when(F.col("id") % 6 == 1, F.array(F.concat(F.lit("Alias "), F.col("id").cast("string")))))
    refs = some.select(F.col("id").alias("ref"), F.when(F.col("id") % 6 == 1, F.concat(F.lit("Alias "), F.col("id").cast("string"))).otherwise(F.concat("name", F.lit(" Inc."))).alias("name"), *resolver.PROVIDERS)
    registry = some.where("id % 9 = 0").select(F.concat(F.lit("steam:s"), F.col("id").cast("string")).alias("key"), (F.col("id") + 1_000_000).alias("id"))
    mapped = some.where("id % 50 = 0").select(F.concat(F.lit("wikidata:Q"), F.col("id").cast("string")).alias("key"), (F.col("id") + 2_000_000).alias("id"))
    names = some.where("id % 40 = 6").select("name", (F.col("id") + 3_000_000).alias("id"))
    apart = some.where("id % 8 = 1").select(F.col("id").alias("a"), (F.col("id") + 4).alias("b"))
    return resolver.match_companies(refs, entries, mapped, names, registry, apart)


BUILDS = """pg AS (SELECT p_partkey AS id FROM part WHERE p_partkey % 20 <> 0), ng AS (SELECT p_partkey AS id FROM part WHERE p_partkey % 30 <> 1),
  pc AS (SELECT s_suppkey AS id, 'Nation ' || s_nationkey AS parent_name FROM supplier WHERE s_suppkey % 6 <> 0), nc AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'Nation ' || s_nationkey END AS parent_name FROM supplier WHERE s_suppkey % 7 <> 1),
  e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p, CASE l_linenumber % 3 WHEN 0 THEN 'developer' WHEN 1 THEN 'publisher' ELSE 'porting' END AS type FROM lineitem),
  pe AS (SELECT * FROM e WHERE (s + p) % 11 <> 0), ne AS (SELECT * FROM e WHERE (s * 3 + p) % 13 <> 0),
  i AS (SELECT user_id AS subject, event_type AS type, event_id FROM events)"""
_ID = "category || ':' || subject || ':' || substr(sha256(details), 1, 12)"


@query(
    "review_candidates",
    f"""WITH {BUILDS}, new_games AS (SELECT id FROM ng WHERE id NOT IN (SELECT id FROM pg)),
    c AS (SELECT 'new-company' AS category, id::VARCHAR AS subject, id::VARCHAR AS details, 'approve reject merge edit ignore' AS actions FROM nc WHERE id NOT IN (SELECT id FROM pc) AND id % 4 <> 0
      UNION ALL SELECT 'new-game', id::VARCHAR, id::VARCHAR, 'approve reject merge edit ignore' FROM new_games
      UNION ALL SELECT 'relationship-change', s::VARCHAR, change || '|' || s || '|' || type || '|' || p, 'approve reject ignore' FROM (SELECT 'added' AS change, * FROM (SELECT * FROM ne EXCEPT SELECT * FROM pe) UNION ALL SELECT 'removed', * FROM (SELECT * FROM pe EXCEPT SELECT * FROM ne)) WHERE type <> 'porting' AND p NOT IN (SELECT id FROM new_games)
      UNION ALL SELECT 'classification-change', nc.id::VARCHAR, coalesce(pc.parent_name, '-') || '|' || coalesce(nc.parent_name, '-'), 'approve edit ignore' FROM nc JOIN pc USING (id) WHERE nc.parent_name IS DISTINCT FROM pc.parent_name
      UNION ALL SELECT 'technology-claim', p_partkey::VARCHAR, p_brand || '|' || CASE WHEN p_size % 2 = 0 THEN 'low' ELSE 'medium' END, 'approve reject edit ignore' FROM part WHERE p_size % 3 <> 0 AND NOT (p_partkey % 4 <> 0 AND p_size % 2 = 0)
      UNION ALL SELECT CASE type WHEN 'click' THEN 'source-conflict' WHEN 'view' THEN 'technology-claim' ELSE 'potential-duplicate' END, subject::VARCHAR,
        CASE type WHEN 'click' THEN 'source-conflict' WHEN 'view' THEN 'unmatched-technology' WHEN 'login' THEN 'ambiguous-match' ELSE 'duplicate' END || '|' || CASE WHEN event_id % 2 = 0 THEN 'externalIds' ELSE '-' END || '|' || (event_id % 10),
        CASE WHEN type = 'click' AND event_id % 5 = 0 THEN 'merge edit ignore' WHEN type = 'click' THEN 'edit ignore' WHEN type = 'view' THEN 'approve merge reject ignore' WHEN type = 'login' AND event_id % 2 = 0 THEN 'edit ignore' ELSE 'merge reject ignore' END FROM i)
    SELECT DISTINCT {_ID} AS id, category, subject, actions FROM c WHERE substr(sha256({_ID}), 1, 1) <> '0'""",
)
def review_candidates(t):
    p, s = F.col("p_partkey"), F.col("s_suppkey")
    named = F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string"))
    role = F.when(F.col("l_linenumber") % 3 == 0, "developer").when(F.col("l_linenumber") % 3 == 1, "publisher").otherwise("porting")
    e = t.lineitem.select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"), role.alias("type")).distinct()
    edges = lambda rows: rows.select(F.col("s").cast("string").alias("from"), "type", F.col("p").cast("string").alias("to"))
    claims = t.part.select(p.alias("game"), F.col("p_brand").alias("technology"), F.when(F.col("p_size") % 3 == 0, "verified").when(F.col("p_size") % 2 == 0, "low").otherwise("medium").alias("confidence"))
    before = {
        "games": t.part.where(p % 20 != 0).select(p.alias("id")), "companies": t.supplier.where(s % 6 != 0).select(s.alias("id"), named.alias("parent_name")),
        "edges": edges(e.where("(s + p) % 11 <> 0")), "claims": claims.where("game % 4 <> 0").withColumn("confidence", F.lit("low")),
    }
    after = {
        "games": t.part.where(p % 30 != 1).select(p.alias("id")), "companies": t.supplier.where(s % 7 != 1).select(s.alias("id"), F.when(s % 5 != 0, named).alias("parent_name")),
        "edges": edges(e.where("(s * 3 + p) % 13 <> 0")), "claims": claims,
    }
    kind = F.when(F.col("event_type") == "click", "source-conflict").when(F.col("event_type") == "view", "unmatched-technology").when(F.col("event_type") == "login", "ambiguous-match").otherwise("duplicate")
    issues = t.events.select(kind.alias("kind"), F.col("user_id").alias("subject"), F.when(F.col("event_id") % 2 == 0, "externalIds").alias("field"), (F.col("event_id") % 10).cast("string").alias("details"), (F.col("event_id") % 5 == 0).alias("suggested"))
    found = review.candidates(before, after, t.supplier.where(s % 4 == 0).select(s.alias("id")), issues, t.spark.createDataFrame([], "id string"))
    return found.where(F.substring(F.sha2("id", 256), 1, 1) != "0")  # stands for what is decided


LINES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query(
    "dataset_diff",
    "WITH b AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey + CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS l_partkey, l_suppkey, CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS l_quantity, l_extendedprice, l_discount, l_tax + CASE WHEN l_orderkey % 13 = 0 THEN 1.0 ELSE 0.0 END AS l_tax, "
    "CASE WHEN l_orderkey % 5 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag, CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus, l_shipdate FROM lineitem WHERE l_orderkey % 9 <> 0), a AS (SELECT l_orderkey * 8 + l_linenumber AS id, * FROM lineitem) "
    + " UNION ALL ".join(f"SELECT a.id, '{f}' AS field FROM a JOIN b USING (id) WHERE a.{f} IS DISTINCT FROM b.{f}" for f in LINES),
)
def dataset_diff(t):
    k = F.col("l_orderkey")
    row = lambda df: df.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), *LINES)
    after = t.lineitem.where(k % 9 != 0).withColumns({
        "l_partkey": F.col("l_partkey") + F.when(k % 7 == 0, 1).otherwise(0), "l_quantity": F.when(k % 11 != 0, F.col("l_quantity")), "l_tax": F.col("l_tax") + F.when(k % 13 == 0, 1.0).otherwise(0.0),
        "l_returnflag": F.when(k % 5 == 0, "X").otherwise(F.col("l_returnflag")), "l_linestatus": F.when(k % 17 != 0, F.col("l_linestatus")),
    })
    return review.changed_fields(row(t.lineitem), row(after), "id").select("id", "field")


def entries_of(t):
    """Corrections whose paths are data: a value, an object put in its place, an object leaf by leaf, and list entries."""
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    one = lambda every, ordinal, op, path, value, source=None: F.when(k % every == 0, F.struct(F.lit(ordinal).alias("ordinal"), F.lit(op).alias("op"), F.lit(path).alias("path"), value.alias("value"), F.lit(source).cast("string").alias("source")))
    steps = F.array_compact(F.array(
        one(4, 1, "set", "title", F.concat(F.lit("Patched "), text), "official"), one(8, 2, "set", "title", F.lit("Again")), one(6, 3, "set", "class.kind", F.lit("indie"), "community"),
        one(12, 4, "set", "class", F.lit("none"), "inferred"), one(24, 5, "set", "class.note", F.lit("back"), "job-posting"), one(3, 6, "append", "tags", F.lit("extra")), one(3, 7, "append", "tags", F.col("p_brand")), one(5, 8, "remove", "tags", F.col("p_type"), "official"),
    ))
    return t.part.select(k.alias("id"), F.explode(steps).alias("s")).select("id", "s.*")


@query(
    "override_paths",
    """SELECT p_partkey AS id, concat_ws('|', CASE WHEN p_partkey % 12 = 0 AND p_partkey % 24 <> 0 THEN 'class=none' END, CASE WHEN p_partkey % 6 = 0 AND p_partkey % 12 <> 0 THEN 'class.kind=indie' WHEN p_partkey % 12 <> 0 THEN 'class.kind=' || p_type END,
      CASE WHEN p_partkey % 24 = 0 THEN 'class.note=back' WHEN p_partkey % 12 <> 0 THEN 'class.note=old' END, 'title=' || CASE WHEN p_partkey % 8 = 0 THEN 'Again' WHEN p_partkey % 4 = 0 THEN 'Patched ' || p_partkey ELSE p_name END) AS leaves,
      concat_ws('|', CASE WHEN p_partkey % 5 <> 0 THEN p_type END, p_brand, CASE WHEN p_partkey % 3 = 0 THEN 'extra' END) AS tags,
      concat_ws('|', CASE WHEN p_partkey % 12 = 0 THEN 'class=inferred' END, CASE WHEN p_partkey % 6 = 0 THEN 'class.kind=low' END, CASE WHEN p_partkey % 24 = 0 THEN 'class.note=medium' END, CASE WHEN p_partkey % 5 = 0 THEN 'tags=verified' WHEN p_partkey % 3 = 0 THEN 'tags=high' END,
        CASE WHEN p_partkey % 8 = 0 THEN 'title=high' WHEN p_partkey % 4 = 0 THEN 'title=verified' END) AS confidence FROM part""",
)
def override_paths(t):
    entities = t.part.select(F.col("p_partkey").alias("id"), F.create_map(F.lit("title"), "p_name", F.lit("class.kind"), "p_type", F.lit("class.note"), F.lit("old")).alias("leaves"), F.create_map(F.lit("tags"), F.array("p_type", "p_brand")).alias("lists"))
    done = overrides.apply_overrides(entities, entries_of(t))
    flat = lambda m, value: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), value(e["value"]))), "|")
    return done.select("id", flat("leaves", lambda v: v).alias("leaves"), F.array_join(F.col("lists")["tags"], "|").alias("tags"), flat("touched", lambda v: v["confidence"]).alias("confidence"))


@query(
    "override_problems",
    """SELECT DISTINCT p_partkey AS id, path, CASE WHEN problem = 'no source' THEN 'warning' ELSE 'error' END AS level, problem FROM (SELECT p_partkey, 'title' AS path, 'no source' AS problem FROM part WHERE p_partkey % 8 = 0
      UNION ALL SELECT p_partkey, 'tags', 'computed field' FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0 UNION ALL SELECT p_partkey, unnest(CASE WHEN p_partkey % 24 = 0 THEN ['class', 'class.kind', 'class.note'] WHEN p_partkey % 12 = 0 THEN ['class', 'class.kind'] ELSE ['class.kind'] END), 'unknown field' FROM part WHERE p_partkey % 6 = 0)""",
)
def override_problems(t):
    field = lambda *names: t.spark.createDataFrame([(n,) for n in names], "field string")
    return overrides.problems(entries_of(t), field("title", "tags", "alias"), field("tags"), field("alias"))


@query(
    "relationship_effects",
    """WITH g AS (SELECT l_partkey AS game, l_suppkey AS company FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY 1, 2),
    o AS (SELECT s_suppkey AS company, s_suppkey % 50 AS game, s_suppkey % 3 = 0 AS remove FROM supplier),
    r AS (SELECT game, company FROM g WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.remove AND o.game = g.game AND o.company = g.company) UNION SELECT game, company FROM o WHERE NOT remove)
    SELECT game, string_agg(company::VARCHAR, '|' ORDER BY company) AS developers, (SELECT count(*) FROM o WHERE o.game = r.game)::BIGINT AS overrides FROM r GROUP BY 1""",
)
def relationship_effects(t):
    """Overrides of a structural kind change the games: a developer by hand joins the list or leaves it."""
    credits = t.lineitem.where("l_linenumber % 2 = 1").select(F.col("l_partkey").alias("game"), F.col("l_suppkey").alias("company")).distinct()
    entries = t.supplier.select((F.col("s_suppkey") % 50).alias("game"), F.col("s_suppkey").alias("company"), (F.col("s_suppkey") % 3 == 0).alias("remove"))
    lists = credits.groupBy("game").agg(F.collect_set("company").alias("had"))
    asked = entries.groupBy("game").agg(F.collect_set(F.when(~F.col("remove"), F.col("company"))).alias("more"), F.collect_set(F.when(F.col("remove"), F.col("company"))).alias("less"), F.count("*").alias("overrides"))
    none = F.expr("cast(array() as array<bigint>)")
    had, more, less = (F.coalesce(c, none) for c in ("had", "more", "less"))
    done = lists.join(asked, "game", "full").select("game", F.array_sort(F.array_union(F.array_except(had, less), more)).alias("companies"), F.coalesce("overrides", F.lit(0)).alias("overrides"))
    return done.where(F.size("companies") > 0).select("game", F.array_join(F.transform("companies", lambda c: c.cast("string")), "|").alias("developers"), "overrides")


@query(
    "override_log",
    """WITH RECURSIVE e AS (SELECT l_partkey AS id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS k, (l_orderkey + 3 * l_linenumber) % 11 AS op, 't' || max(l_quantity)::INT AS v, 'v' || (max(l_suppkey) % 4) AS w FROM lineitem GROUP BY l_partkey, l_orderkey, l_linenumber),
    t AS (SELECT p_partkey AS id, 0::BIGINT AS k, p_partkey % 5 <> 0 AS alive, false AS excluded, false AS created, CASE WHEN p_partkey % 5 <> 0 THEN p_name END AS title, NULL::VARCHAR AS sub, CASE WHEN p_partkey % 5 <> 0 THEN [p_brand] END AS tags, NULL::VARCHAR AS kind, 0::BIGINT AS problems FROM part
      UNION ALL SELECT t.id, e.k, CASE op WHEN 0 THEN false WHEN 1 THEN true ELSE alive END, excluded OR op = 0, created OR (op = 1 AND NOT alive),
        CASE WHEN op = 0 OR op = 1 AND NOT alive THEN NULL WHEN alive AND op IN (2, 3) THEN v WHEN alive AND op = 4 THEN NULL ELSE title END, CASE WHEN op = 0 OR op = 1 AND NOT alive THEN NULL WHEN alive AND op = 4 THEN v WHEN alive AND op IN (2, 3) THEN NULL ELSE sub END,
        CASE WHEN op = 0 OR op = 1 AND NOT alive THEN NULL WHEN alive AND op = 10 THEN NULL WHEN alive AND op IN (5, 6, 7) THEN CASE WHEN list_contains(coalesce(tags, []), w) THEN tags ELSE list_append(coalesce(tags, []), w) END WHEN alive AND op IN (8, 9) THEN list_filter(coalesce(tags, []), lambda x: x <> w) ELSE tags END,
        CASE WHEN op = 0 OR op = 1 AND NOT alive THEN NULL WHEN alive AND op = 10 THEN w WHEN alive AND op IN (5, 6, 7, 8, 9) THEN NULL ELSE kind END, problems + CASE WHEN NOT alive AND op > 1 THEN 1 ELSE 0 END
      FROM t JOIN e ON e.id = t.id AND e.k = t.k + 1)
    SELECT id, alive, excluded, created, concat_ws('|', 'tags.kind=' || kind, 'title=' || title, 'title.sub=' || sub) AS leaves, array_to_string(tags, '|') AS tags, problems FROM t WHERE (id, k) IN (SELECT id, max(k) FROM t GROUP BY 1)""",
)
def override_log(t):
    """Logs that exclude, create anew, set, append and remove in any order, folded one entry after another."""
    p, op = F.col("p_partkey"), (F.col("l_orderkey") + 3 * F.col("l_linenumber")) % 11
    entities = t.part.where(p % 5 != 0).select(p.alias("id"), F.create_map(F.lit("title"), "p_name").alias("leaves"), F.create_map(F.lit("tags"), F.array("p_brand")).alias("lists"))
    named = F.when(op == 0, "exclude").when(op == 1, "create").when(op.isin(2, 3, 4, 10), "set").when(op < 8, "append").otherwise("remove")
    path = F.when(op < 2, None).when(op == 4, "title.sub").when(op < 4, "title").when(op == 10, "tags.kind").otherwise("tags")
    lines = t.lineitem.groupBy("l_partkey", "l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.max("l_suppkey").alias("l_suppkey"))
    value = F.when(op.isin(2, 3, 4), F.concat(F.lit("t"), F.col("l_quantity").cast("int").cast("string"))).otherwise(F.concat(F.lit("v"), (F.col("l_suppkey") % 4).cast("string")))
    entries = lines.select(F.col("l_partkey").alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"), named.alias("op"), path.alias("path"), value.alias("value"), F.lit(None).cast("string").alias("source"))
    done = overrides.apply_log(entities, entries).join(t.part.select(p.alias("id")), "id", "right")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    leaves = F.array_join(F.transform(F.array_sort(F.map_entries("leaves")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return done.select("id", flag("exists").alias("alive"), flag("excluded").alias("excluded"), flag("created").alias("created"), F.coalesce(leaves, F.lit("")).alias("leaves"), F.array_join(F.col("lists")["tags"], "|").alias("tags"), F.coalesce(F.size("problems"), F.lit(0)).cast("long").alias("problems"))


@query(
    "override_json",
    """SELECT id, path, value FROM (SELECT p_partkey AS id, unnest([{'path': 'title', 'value': '"P ' || p_partkey || '"'}, {'path': 'class.kind', 'value': 'null'}, {'path': 'class.deep.list', 'value': '[1,{"a":2,"b":' || p_size || '}]'},
      {'path': 'class.deep.none', 'value': '{}'}, {'path': 'tags', 'value': '["' || p_brand || '"' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ',{"a":1,"b":2}' END || ']'}], recursive := true) FROM part)""",
)
def override_json(t):
    """Entries as JSON text with keys in any order and values of any shape, read and folded."""
    k = F.col("p_partkey").cast("string")
    first = F.concat(F.lit('{"set": {"class": {"deep": {"none": {}, "list": [1.0, {"b": '), F.col("p_size").cast("string"), F.lit(', "a": 2}]}, "kind": null}, "title": "P '), k, F.lit('"}, "append": {"tags": [{"b": 2, "a": 1}, {"a": 1, "b": 2}]}}'))
    later = F.when(F.col("p_partkey") % 3 == 0, F.lit('{"remove": {"tags": [{"a":1.00,"b":2}]}}')).otherwise(F.lit('{"append": {"tags": []}}'))
    entries = t.part.select(F.col("p_partkey").alias("id"), F.posexplode(F.array(first, later)).alias("ordinal", "json")).withColumn("source", F.lit("official"))
    entities = t.part.select(F.col("p_partkey").alias("id"), F.create_map(F.lit("class.kind.old"), F.lit("1")).alias("leaves"), F.create_map(F.lit("tags"), F.array(F.to_json(F.array("p_brand")).substr(F.lit(2), F.length("p_brand") + 2))).alias("lists"))
    done = overrides.apply_log(entities, overrides.read_entries(entries))
    lists = F.transform(F.map_entries("lists"), lambda e: F.struct(e["key"].alias("path"), F.concat(F.lit("["), F.array_join(e["value"], ","), F.lit("]")).alias("value")))
    leaves = F.transform(F.map_entries("leaves"), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("value")))
    return done.select("id", F.explode(F.concat(leaves, lists)).alias("x")).select("id", "x.path", "x.value")
