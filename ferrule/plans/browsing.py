"""The read side: filters, facets, search, sorts and pages' lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ferrule.functions import columns as C
from ferrule.operators.core import numbered, top_by
from ferrule.plans.base import query


@query("filter_games", "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#34') AND p_size BETWEEN 5 AND 30 AND lower(p_name || ' ' || p_type) LIKE '%re%'")
def filter_games(t):
    haystack = C.words_only(F.concat_ws(" ", "p_name", "p_type"))
    return t.part.where(F.col("p_brand").isin("Brand#11", "Brand#23", "Brand#34") & F.col("p_size").between(5, 30) & F.contains(haystack, F.lit("re"))).select("p_partkey")


@query("filter_companies", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 0 AND n_regionkey IN (1, 2)")
def filter_companies(t):
    nations = t.nation.where(F.col("n_regionkey").isin(1, 2)).select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return t.supplier.where("s_acctbal > 0").join(nations, "s_nationkey").select("s_suppkey", "n_name")


@query("filter_technologies", "SELECT DISTINCT p_brand FROM part WHERE p_size > 10 AND contains(lower(p_brand), '#2')")
def filter_technologies(t):
    return t.part.where((F.col("p_size") > 10) & F.contains(F.lower("p_brand"), F.lit("#2"))).select("p_brand").distinct()


@query("filter_json_text", """SELECT c_custkey FROM customer WHERE contains(lower('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}'), 'mach')""")
def filter_json_text(t):
    text = F.lower(F.to_json(F.struct("c_custkey", "c_name", "c_mktsegment")))
    return t.customer.where(F.contains(text, F.lit("mach"))).select("c_custkey")


HOME = "g AS (SELECT p_partkey AS id, p_type, sum(l_quantity)::BIGINT AS reviews, max(l_shipdate)::DATE AS date FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"


@query(
    "home_lists",
    f"""WITH {HOME}, a AS (SELECT 'reviewed' AS list, id, row_number() OVER (ORDER BY reviews DESC, id)::BIGINT AS position FROM g WHERE reviews > 0),
    b AS (SELECT 'recent' AS list, id, row_number() OVER (ORDER BY date DESC, id)::BIGINT AS position FROM g WHERE p_type IN ('STANDARD', 'SMALL', 'MEDIUM') AND date IS NOT NULL)
    SELECT * FROM a WHERE position <= 8 UNION ALL SELECT * FROM b WHERE position <= 6""",
)
def home_lists(t):
    g = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(F.sum("l_quantity").cast("long").alias("reviews"), F.max(F.col("l_shipdate").cast("date")).alias("date")).join(t.part.select(F.col("p_partkey").alias("id"), "p_type"), "id")
    a = top_by(g.where("reviews > 0"), [F.col("reviews").desc(), F.col("id")], 8, name="position").select(F.lit("reviewed").alias("list"), "id", "position")
    b = top_by(g.where(F.col("p_type").isin("STANDARD", "SMALL", "MEDIUM") & F.col("date").isNotNull()), [F.col("date").desc(), F.col("id")], 6, name="position").select(F.lit("recent").alias("list"), "id", "position")
    return a.unionByName(b)


@query("facet_counts", "SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1")
def facet_counts(t):
    return t.part.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("country_facet", "SELECT n_name AS country, count(*)::BIGINT AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40")
def country_facet(t):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return counts.join(t.nation, "n_nationkey").select(F.col("n_name").alias("country"), "n").orderBy(F.col("n").desc(), "country").limit(40)


@query("category_sums", "SELECT p_type AS category, sum(n)::BIGINT AS games FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY 1")
def category_sums(t):
    return t.part.groupBy("p_type", "p_brand").agg(F.count("*").alias("n")).groupBy(F.col("p_type").alias("category")).agg(F.sum("n").alias("games"))


@query(
    "group_ordering",
    """WITH b AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2), g AS (SELECT p_type, sum(n) AS total FROM b GROUP BY 1)
    SELECT row_number() OVER (ORDER BY total DESC, p_type)::BIGINT AS position, p_type, p_brand, n::BIGINT AS n FROM (SELECT b.*, g.total, row_number() OVER (PARTITION BY b.p_type ORDER BY n DESC, p_brand) AS k FROM b JOIN g USING (p_type)) WHERE k = 1""",
)
def group_ordering(t):
    b = t.part.groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))
    g = b.groupBy("p_type").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("m"), "p_brand")).alias("best"))
    return g.select(F.row_number().over(Window.orderBy(F.col("total").desc(), "p_type")).cast("long").alias("position"), "p_type", F.col("best.p_brand").alias("p_brand"), (-F.col("best.m")).alias("n"))


@query("top_members", "SELECT p_type, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k <= 3")
def top_members(t):
    return top_by(t.part, [F.col("p_retailprice").desc(), F.col("p_partkey")], 3, ["p_type"]).select("p_type", "p_partkey", "p_retailprice")


@query(
    "search_score",
    """WITH e AS (SELECT p_partkey AS id, lower(p_name) AS label, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AS alias, p_size AS weight FROM part),
    s AS (SELECT *, CASE WHEN label = 'red' THEN 100 WHEN starts_with(label, 'red') THEN 80 WHEN contains(label, ' red') THEN 60 WHEN contains(label, 'red') THEN 40
      WHEN alias = 'red' THEN 70 WHEN starts_with(alias, 'red') THEN 50 WHEN contains(alias, 'red') THEN 25 ELSE 0 END AS score FROM e)
    SELECT id, score::INT AS score, row_number() OVER (ORDER BY score DESC, weight DESC, id)::BIGINT AS rank FROM s WHERE score > 0 ORDER BY score DESC, weight DESC, id LIMIT 8""",
)
def search_score(t):
    e = t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("weight"), C.search_score(F.col("p_name"), F.array("p_brand"), "red").alias("score")).where("score > 0")
    return top_by(e, [F.col("score").desc(), F.col("weight").desc(), F.col("id")], 8).select("id", "score", "rank")


@query(
    "sort_nulls_last",
    """WITH v AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS v FROM customer)
    SELECT c_custkey, row_number() OVER (ORDER BY v ASC NULLS LAST, c_custkey)::BIGINT AS up, row_number() OVER (ORDER BY v DESC NULLS LAST, c_custkey)::BIGINT AS down FROM v""",
)
def sort_nulls_last(t):
    v = F.nullif(F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_mktsegment")), F.lit(""))
    rows = numbered(t.customer.select("c_custkey", v.alias("v")), [F.col("v").asc_nulls_last(), F.col("c_custkey")], "up")
    return numbered(rows, [F.col("v").desc_nulls_last(), F.col("c_custkey")], "down").drop("v")


@query("natural_sort", "SELECT s_suppkey, row_number() OVER (ORDER BY (string_split(s_name, '#')[2])::BIGINT, s_suppkey)::BIGINT AS position FROM supplier")
def natural_sort(t):
    padded = F.regexp_replace(F.regexp_replace(F.concat(F.lit("x"), F.regexp_extract("s_name", r"(\d+)$", 1)), "x0*", ""), r"^(\d+)$", "$1")
    key = F.lpad(padded, 20, "0")
    return numbered(t.supplier.select("s_suppkey", key.alias("key")), [F.col("key"), F.col("s_suppkey")]).drop("key")


@query("related_by_category", "SELECT a AS id, b AS related FROM (SELECT x.p_partkey AS a, y.p_partkey AS b, row_number() OVER (PARTITION BY x.p_partkey ORDER BY y.p_retailprice DESC, y.p_partkey) AS k FROM part AS x JOIN part AS y ON x.p_brand = y.p_brand AND x.p_type = y.p_type AND x.p_partkey <> y.p_partkey) WHERE k <= 8")
def related_by_category(t):
    # of each category only its first nine can be among the first eight related ones of any member
    best = top_by(t.part, [F.col("p_retailprice").desc(), F.col("p_partkey")], 9, ["p_brand", "p_type"], name="place").select("p_brand", "p_type", F.col("p_partkey").alias("related"), "place")
    pairs = t.part.select(F.col("p_partkey").alias("id"), "p_brand", "p_type").join(best, ["p_brand", "p_type"]).where("id <> related")
    return top_by(pairs, [F.col("place")], 8, ["id"], name="k").select("id", "related")


@query("company_games", "SELECT l_suppkey AS company, l_partkey AS game, row_number() OVER (PARTITION BY l_suppkey ORDER BY CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE q END DESC NULLS LAST, l_partkey)::BIGINT AS position FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)")
def company_games(t):
    q = t.lineitem.groupBy(F.col("l_suppkey").alias("company"), F.col("l_partkey").alias("game")).agg(F.sum("l_quantity").alias("q"))
    reviews = F.when(F.col("game") % 9 != 0, F.col("q"))
    return q.select("company", "game", F.row_number().over(Window.partitionBy("company").orderBy(reviews.desc_nulls_last(), "game")).cast("long").alias("position"))


@query("related_ids", "SELECT id, string_agg(r::VARCHAR, '|' ORDER BY r) AS related FROM (SELECT DISTINCT p_partkey AS id, unnest([p_partkey - 1, p_partkey + 1, p_partkey, p_partkey - 1]) AS r FROM part) WHERE r <> id AND r IN (SELECT p_partkey FROM part) GROUP BY 1")
def related_ids(t):
    k = F.col("p_partkey")
    wanted = t.part.select(k.alias("id"), F.explode(F.array_distinct(F.array(k - 1, k + 1, k, k - 1))).alias("r")).where("r <> id")
    return wanted.join(t.part.select(k.alias("r")), "r", "left_semi").groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_set("r")), lambda x: x.cast("string")), "|").alias("related"))


@query("option_lists", "SELECT DISTINCT 'status' AS list, o_orderstatus AS option FROM orders UNION ALL SELECT DISTINCT 'type', p_type FROM part")
def option_lists(t):
    return t.orders.select(F.lit("status").alias("list"), F.col("o_orderstatus").alias("option")).distinct().unionByName(t.part.select(F.lit("type").alias("list"), F.col("p_type").alias("option")).distinct())


@query("studio_names", "SELECT l_orderkey, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS studios FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_suppkey % 10 <> 0 GROUP BY 1")
def studio_names(t):
    known = t.supplier.where("s_suppkey % 10 <> 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return t.lineitem.select("l_orderkey", "l_suppkey").distinct().join(known, "l_suppkey").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("s_name")), ", ").alias("studios"))


@query("binary_id_order", "SELECT doc_id, row_number() OVER (ORDER BY source || ':' || doc_id)::BIGINT AS position FROM documents")
def binary_id_order(t):
    key = F.concat("source", F.lit(":"), F.col("doc_id").cast("string"))
    return numbered(t.documents.select("doc_id", key.alias("key")), [F.col("key")]).drop("key")


@query("category_counts", "SELECT o_orderpriority AS category, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def category_counts(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("category")).agg(F.count("*").alias("n"))


NATURAL = "n AS (SELECT s_suppkey AS id, s_suppkey % 17 = 0 AS blank, (['act', 'Bonus', 'épilogue', 'vol'])[1 + s_suppkey % 4] AS word, s_suppkey % 3 AS w, s_suppkey % 13 AS a, s_suppkey % 7 * 100000000000 AS b, s_suppkey % 101 AS c FROM supplier)"


@query(
    "natural_collation",
    f"""WITH {NATURAL} SELECT id, row_number() OVER (ORDER BY blank, CASE WHEN NOT blank THEN lower(strip_accents(word)) END, CASE WHEN NOT blank THEN a END, CASE WHEN NOT blank THEN b END, CASE WHEN NOT blank THEN c END, id)::BIGINT AS up,
      row_number() OVER (ORDER BY blank, CASE WHEN NOT blank THEN lower(strip_accents(word)) END DESC, CASE WHEN NOT blank THEN a END DESC, CASE WHEN NOT blank THEN b END DESC, CASE WHEN NOT blank THEN c END DESC, id)::BIGINT AS down FROM n""",
)
def natural_collation(t):
    """Names of several words and numbers, in the order of the collation and of the numbers' values; blanks last both ways."""
    k = F.col("s_suppkey")
    word = F.get(F.array(*(F.lit(w) for w in ("act", "Bonus", "épilogue", "vol"))), (k % 4).cast("int"))
    name = F.format_string("%s %d.%03d part %d", word, k % 13, k % 7 * 100000000000, k % 101)
    rows = t.supplier.select(k.alias("id"), F.when(k % 17 == 0, F.when(k % 2 == 0, "")).otherwise(name).alias("name"))
    rows = rows.withColumns({"blank": F.coalesce(F.col("name") == "", F.lit(True)), "key": C.natural_key(F.coalesce("name", F.lit("")))})
    up = numbered(rows, [F.col("blank"), F.col("key"), F.col("id")], "up")
    return numbered(up, [F.col("blank"), F.col("key").desc(), F.col("id")], "down").select("id", "up", "down")
