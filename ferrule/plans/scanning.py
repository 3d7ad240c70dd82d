"""Scans: statements as records, discovery, cached responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.plans.base import query
from ferrule.sources import eav, files


def statements(t):
    e = t.events.select((F.col("user_id") % 50).alias("item"), F.col("event_type").alias("property"), F.col("user_id").cast("string").alias("value"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("label"), F.col("event_id").alias("ordinal"))
    return e


EAV = "s AS (SELECT user_id % 50 AS item, event_type AS property, user_id::VARCHAR AS value, 'u' || user_id AS label FROM events)"


@query("eav_pairs", f"WITH {EAV}, d AS (SELECT DISTINCT item, property, value, label FROM s) SELECT item, property, string_agg(label, '|' ORDER BY label) AS labels FROM d GROUP BY 1, 2")
def eav_pairs(t):
    return eav.pairs(statements(t)).select("item", "property", F.array_join(F.transform("values", lambda v: v["label"]), "|").alias("labels"))


@query("eav_pivot", f"WITH {EAV}, d AS (SELECT DISTINCT item, property, value FROM s WHERE property IN ('click', 'view')) SELECT item, coalesce(string_agg(value, '|' ORDER BY value) FILTER (property = 'click'), '') AS click, coalesce(string_agg(value, '|' ORDER BY value) FILTER (property = 'view'), '') AS view FROM d GROUP BY 1")
def eav_pivot(t):
    p = eav.pivoted(statements(t), ["click", "view"])
    return p.select("item", F.array_join("click", "|").alias("click"), F.array_join("view", "|").alias("view"))


@query("eav_dates", "SELECT item, CASE precision WHEN 9 THEN substr(time, 1, 4) WHEN 10 THEN substr(time, 1, 7) ELSE time END AS date FROM (SELECT o_custkey AS item, strftime(o_orderdate, '%Y-%m-%d') AS time, 9 + o_orderkey % 3 AS precision, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, 9 + o_orderkey % 3) AS n FROM orders WHERE o_orderstatus <> 'P') WHERE n = 1")
def eav_dates(t):
    d = t.orders.select(F.col("o_custkey").alias("item"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("time"), (9 + F.col("o_orderkey") % 3).alias("precision"), F.when(F.col("o_orderstatus") == "P", "deprecated").otherwise("normal").alias("rank"))
    return eav.earliest_dates(d)


@query("eav_labels", "SELECT c_nationkey AS item, first('n' || c_custkey ORDER BY c_mktsegment <> 'BUILDING', c_mktsegment, 'n' || c_custkey) AS label, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS aliases FROM customer GROUP BY 1")
def eav_labels(t):
    n = t.customer.select(F.col("c_nationkey").alias("item"), F.col("c_mktsegment").alias("lang"), F.concat(F.lit("n"), F.col("c_custkey").cast("string")).alias("label"), F.col("c_mktsegment").alias("alias"))
    return eav.labels(n, "BUILDING").select("item", "label", F.array_join("aliases", "|").alias("aliases"))


@query(
    "discover_games",
    """WITH r AS (SELECT l_partkey AS item, l_suppkey AS company, CASE l_linenumber % 2 WHEN 1 THEN 'developer' ELSE 'publisher' END AS role FROM lineitem), i AS (SELECT l_partkey AS item, min(l_orderkey) AS store_id FROM lineitem WHERE l_discount = 0.05 GROUP BY 1)
    SELECT DISTINCT item, company, role, store_id FROM r LEFT JOIN i USING (item) WHERE item IN (SELECT p_partkey FROM part WHERE p_type IN ('STANDARD', 'SMALL'))""",
)
def discover_games(t):
    r = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("company"), "l_linenumber")
    kinds = t.part.where(F.col("p_type").isin("STANDARD", "SMALL")).select(F.col("p_partkey").alias("item"))
    ids = t.lineitem.where("l_discount = 0.05").select(F.col("l_partkey").alias("item"), F.col("l_orderkey").cast("string").alias("id"))
    return eav.discovered(r.where("l_linenumber % 2 = 1").drop("l_linenumber"), r.where("l_linenumber % 2 = 0").drop("l_linenumber"), kinds, ids).select("item", "company", "role", "store_id")


@query("chosen_types", "SELECT p_brand AS item, CASE WHEN bool_or(p_type = 'PROMO') THEN 'PROMO' WHEN bool_or(p_type = 'LARGE') THEN 'LARGE' WHEN bool_or(p_type = 'SMALL') THEN 'SMALL' END AS type FROM part WHERE p_type IN ('PROMO', 'LARGE', 'SMALL') GROUP BY 1")
def chosen_types(t):
    return eav.chosen_type(t.part.select(F.col("p_brand").alias("item"), F.col("p_type").alias("type")), ["PROMO", "LARGE", "SMALL"])


@query("company_lookup", "SELECT s_nationkey AS company, s_suppkey AS candidate FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier) WHERE n <= 10")
def company_lookup(t):
    from ferrule.operators.core import top_by

    return top_by(t.supplier, [F.col("s_suppkey")], 10, ["s_nationkey"]).select(F.col("s_nationkey").alias("company"), F.col("s_suppkey").alias("candidate"))


@query("country_codes", "SELECT s_suppkey AS id, upper(substr(n_name, 1, 2)) AS country FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def country_codes(t):
    codes = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.upper(F.substring("n_name", 1, 2)).alias("country"))
    return t.supplier.join(codes, "s_nationkey").select(F.col("s_suppkey").alias("id"), "country")


@query(
    "cached_responses",
    """WITH r AS (SELECT user_id AS key, ts AS fetched_at, CASE WHEN event_id % 10 = 0 THEN 404 ELSE 200 END AS status, event_type || event_id AS body FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC, status DESC, body DESC) AS k FROM r)
    SELECT key, status::INT AS status, CASE WHEN status < 400 THEN body END AS body FROM n WHERE k = 1 AND fetched_at >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 20 HOUR""",
)
def cached_responses(t):
    raw = t.events.select(F.col("user_id").alias("key"), F.col("ts").alias("fetched_at"), F.when(F.col("event_id") % 10 == 0, 404).otherwise(200).alias("status"), F.concat("event_type", F.col("event_id").cast("string")).alias("body"))
    return files.cached_responses(raw, "2024-01-30 12:00:00", 20 / 24)


@query("mapped_flags", "SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'developer' WHEN '2-HIGH' THEN 'publisher' ELSE 'supporting' END AS role, CASE WHEN o_orderkey % 2 = 0 THEN 'steam' END AS first_external FROM orders")
def mapped_flags(t):
    k = F.col("o_orderkey")
    flags = F.array(F.struct(F.lit("developer").alias("role"), (F.col("o_orderpriority") == "1-URGENT").alias("on")), F.struct(F.lit("publisher").alias("role"), (F.col("o_orderpriority") == "2-HIGH").alias("on")))
    external = F.array(F.struct(F.lit("steam").alias("name"), (k % 2 == 0).alias("on")), F.struct(F.lit("gog").alias("name"), F.lit(False).alias("on")))
    return t.orders.select(k.alias("id"), F.coalesce(F.get(F.filter(flags, lambda x: x["on"]), 0)["role"], F.lit("supporting")).alias("role"), F.get(F.filter(external, lambda x: x["on"]), 0)["name"].alias("first_external"))


@query("provider_status", "SELECT event_type AS provider, CASE WHEN count(*) FILTER (value > 150) > 0 THEN 'error' WHEN event_type = 'click' THEN 'skipped' ELSE 'ok' END AS status FROM events GROUP BY 1")
def provider_status(t):
    s = t.events.groupBy(F.col("event_type").alias("provider")).agg(F.count_if(F.col("value") > 150).alias("errors"))
    return s.select("provider", F.when(F.col("errors") > 0, "error").when(F.col("provider") == "click", "skipped").otherwise("ok").alias("status"))


@query(
    "resolved_ids",
    """WITH w AS (SELECT DISTINCT l_partkey AS id FROM lineitem), n AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 100 AS batch FROM w)
    SELECT n.id, batch::BIGINT AS batch, p_brand AS item FROM n JOIN part ON p_partkey = n.id WHERE p_partkey % 5 <> 0""",
)
def resolved_ids(t):
    """Ids asked for in batches of 100, in their order; what nothing has is left out of the answers."""
    from ferrule.operators.core import numbered

    wanted = numbered(t.lineitem.select(F.col("l_partkey").alias("id")).distinct(), [F.col("id")])
    batch = F.floor((F.col("position") - 1) / 100).cast("long")
    items = t.part.where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("item"))
    return wanted.select("id", batch.alias("batch")).join(items, "id")
