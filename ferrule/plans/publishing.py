"""Published views: compact rows, unions for search, nested documents as rows, checksums."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.operators.core import content_digest
from ferrule.plans.base import digest_sql, query


@query("compact_projection", "SELECT p_partkey AS id, p_name AS title, p_type AS type, q AS review_count, coalesce(engines, '') AS engines FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity)::BIGINT AS q, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS engines FROM lineitem GROUP BY 1) ON l_partkey = p_partkey")
def compact_projection(t):
    s = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.struct(F.sum("l_quantity").cast("long").alias("reviews"), F.array_sort(F.collect_set(F.struct(F.col("l_returnflag").alias("id")))).alias("engines")).alias("statistics"))
    return t.part.join(s, "p_partkey", "left").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("type"), F.col("statistics.reviews").alias("review_count"), F.coalesce(F.array_join(F.transform("statistics.engines", lambda e: e["id"]), "|"), F.lit("")).alias("engines"))


@query("standard_views", "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier")
def standard_views(t):
    full = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.struct(F.lit("seed").alias("source"), F.lit("high").alias("confidence")).alias("provenance"))
    return full.drop("provenance")


@query("index_union", "SELECT 'game' AS type, p_partkey AS id, p_name AS name FROM part UNION ALL SELECT 'company', s_suppkey, s_name FROM supplier UNION ALL SELECT 'person', c_custkey, c_name FROM customer")
def index_union(t):
    out = None
    for kind, table, prefix, key in (("game", t.part, "p", "p_partkey"), ("company", t.supplier, "s", "s_suppkey"), ("person", t.customer, "c", "c_custkey")):
        one = table.select(F.lit(kind).alias("type"), F.col(key).alias("id"), F.col(f"{prefix}_name").alias("name"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "search_index_union",
    """SELECT 'game' AS kind, 'g' || p_partkey AS id, p_name AS label, p_type AS meta, coalesce(q, 0)::BIGINT AS weight FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
    UNION ALL SELECT 'company', 'c' || s_suppkey, s_name, n_name, coalesce(n, 0)::BIGINT FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey""",
)
def search_index_union(t):
    q = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("q"))
    n = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_partkey").distinct().groupBy("s_suppkey").agg(F.count("*").alias("n"))
    games = t.part.join(q, "p_partkey", "left").select(F.lit("game").alias("kind"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("label"), F.col("p_type").alias("meta"), F.coalesce("q", F.lit(0)).cast("long").alias("weight"))
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    companies = t.supplier.join(nations, "s_nationkey", "left").join(n, "s_suppkey", "left").select(F.lit("company").alias("kind"), F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("label"), F.col("n_name").alias("meta"), F.coalesce("n", F.lit(0)).cast("long").alias("weight"))
    return games.unionByName(companies)


@query("nested_views", "SELECT DISTINCT l_suppkey AS company, CASE l_linenumber % 2 WHEN 1 THEN 'developed' ELSE 'published' END AS list, p_partkey AS game, p_name AS title FROM lineitem JOIN part ON p_partkey = l_partkey")
def nested_views(t):
    role = F.when(F.col("l_linenumber") % 2 == 1, "developed").otherwise("published")
    rows = t.lineitem.select(F.col("l_suppkey").alias("company"), role.alias("list"), F.col("l_partkey").alias("p_partkey")).distinct().join(t.part.select("p_partkey", "p_name"), "p_partkey")
    docs = rows.groupBy("company").agg(F.array_sort(F.collect_list(F.struct("list", F.col("p_partkey").alias("game"), F.col("p_name").alias("title")))).alias("games"))
    return docs.select("company", F.explode("games").alias("g")).select("company", "g.*")


FILES = (("supplier", "s_suppkey", "s_name"), ("nation", "n_nationkey", "n_name"), ("part", "p_partkey", "p_name"))


@query("manifest_checksums", " UNION ALL ".join(f"SELECT '{n}' AS file, * FROM ({digest_sql(f'SELECT {k} || chr(124) || {v} AS line FROM {n}')})" for n, k, v in FILES))
def manifest_checksums(t):
    found = [content_digest(getattr(t, n), F.concat_ws("|", F.col(k).cast("string"), v)).select(F.lit(n).alias("file"), "*") for n, k, v in FILES]
    return functools.reduce(DataFrame.unionByName, found)


@query("blank_rows", "SELECT s_suppkey AS id, 'unknown' AS status, 0::BIGINT AS game_count, NULL::DOUBLE AS average FROM supplier WHERE s_suppkey % 5 = 0")
def blank_rows(t):
    return t.supplier.where("s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("id"), F.lit("unknown").alias("status"), F.lit(0).cast("long").alias("game_count"), F.lit(None).cast("double").alias("average"))


@query("provenance_rows", "SELECT p_partkey AS id, f AS field, CASE f WHEN 'title' THEN 'steam' ELSE 'igdb' END AS source FROM part, (VALUES ('title'), ('type')) AS v(f)")
def provenance_rows(t):
    fields = F.create_map(F.lit("title"), F.struct(F.lit("steam").alias("source")), F.lit("type"), F.struct(F.lit("igdb").alias("source")))
    return t.part.select(F.col("p_partkey").alias("id"), F.explode(fields).alias("field", "p")).select("id", "field", "p.source")


@query("snapshot_paths", r"SELECT path, count(*)::BIGINT AS n FROM (SELECT regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages) WHERE NOT (starts_with(path, 'en/') OR starts_with(path, 'de/9')) GROUP BY 1")
def snapshot_paths(t):
    # the paths of pages stand for files; two prefixes for the folders that a snapshot leaves out
    paths = t.pages.select(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1).alias("path"))
    kept = paths.where(~(F.startswith(F.col("path"), F.lit("en/")) | F.startswith(F.col("path"), F.lit("de/9"))))
    return kept.groupBy("path").agg(F.count("*").alias("n"))


@query("canonical_json", """SELECT s_suppkey AS id, '{"id":' || s_suppkey || ',"name":"' || s_name || '","nation":' || s_nationkey || '}' AS json, substr(sha256('{"id":' || s_suppkey || ',"name":"' || s_name || '","nation":' || s_nationkey || '}'), 1, 12) AS hash FROM supplier""")
def canonical_json(t):
    json = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")), {"ignoreNullFields": "false"})
    return t.supplier.select(F.col("s_suppkey").alias("id"), json.alias("json"), F.substring(F.sha2(json, 256), 1, 12).alias("hash"))


@query("release_notes", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*)::BIGINT AS added, '## ' || strftime(o_orderdate, '%Y-%m') || ' (' || count(*) || ')' AS line FROM orders GROUP BY 1")
def release_notes(t):
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("added"))
    return m.withColumn("line", F.format_string("## %s (%d)", "month", "added"))


@query("streaming_observation", """WITH p AS (SELECT user_id, event_id, ts::DATE AS day, value, max(ts::DATE) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM events)
    SELECT user_id, day, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY event_id DESC) AS n FROM p WHERE last IS NULL OR day >= last) WHERE n = 1""")
def streaming_observation(t):
    from ferrule.operators.core import shared_folder
    from ferrule.streaming.observations import run

    folder = shared_folder(t.spark)
    return run(t.spark, f"{t.folder}/events.parquet*", f"{folder}/points", f"{folder}/offsets")
