"""Statistics: suppliers are companies, brands technologies, nations publishers, events observations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ferrule.functions.columns import ratio, rounded
from ferrule.operators.core import first_by, observations, shared_folder, thinned_history, top_by
from ferrule.plans.base import query

GAMES = """g AS (SELECT l_partkey AS game, sum(l_quantity)::BIGINT AS reviews, count(*) FILTER (l_returnflag = 'N')::BIGINT AS good, count(*)::BIGINT AS lines,
  min(strftime(l_shipdate, '%Y-%m-%d')) AS released FROM lineitem GROUP BY 1)"""


def games(t):
    return t.lineitem.groupBy(F.col("l_partkey").alias("game")).agg(
        F.sum("l_quantity").cast("long").alias("reviews"), F.count_if(F.col("l_returnflag") == "N").alias("good"), F.count("*").alias("lines"), F.min(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("released")
    )


@query(
    "company_statistics",
    f"""WITH {GAMES}, e AS (SELECT l_suppkey AS company, l_partkey AS game, max((l_linenumber % 2 = 1)::INT) AS dev, max((l_linenumber % 2 = 0)::INT) AS pub FROM lineitem GROUP BY 1, 2),
    j AS (SELECT e.company, e.dev, e.pub, g.*, p_brand AS tech, CASE WHEN lines >= 20 THEN good::DOUBLE / lines END AS pct FROM e JOIN g USING (game) JOIN part ON p_partkey = game),
    s AS (SELECT company, count(*)::BIGINT AS game_count, sum(dev)::BIGINT AS developed_count, sum(pub)::BIGINT AS published_count, sum(reviews)::BIGINT AS total_reviews,
      floor(avg(pct) * 1000.0 + 0.5) / 10.0 AS average_positive, floor(sum(good)::DOUBLE / sum(lines)::DOUBLE * 1000.0 + 0.5) / 10.0 AS weighted_positive,
      count(DISTINCT tech)::BIGINT AS technology_count, string_agg(DISTINCT tech, '|' ORDER BY tech) AS technologies FROM j GROUP BY 1),
    m AS (SELECT company, first(game ORDER BY reviews DESC, game) AS most_reviewed, first(game ORDER BY released, game) AS first_release, first(game ORDER BY released DESC, game DESC) AS latest_release FROM j GROUP BY 1)
    SELECT * FROM s JOIN m USING (company)""",
)
def company_statistics(t):
    odd = F.col("l_linenumber") % 2 == 1
    edges = t.lineitem.groupBy(F.col("l_suppkey").alias("company"), F.col("l_partkey").alias("game")).agg(F.max(odd.cast("int")).alias("dev"), F.max((~odd).cast("int")).alias("pub"))
    j = edges.join(games(t), "game").join(t.part.select(F.col("p_partkey").alias("game"), F.col("p_brand").alias("tech")), "game")
    # ties are told apart within the struct, so that all of it is one aggregation
    best = F.min(F.struct((-F.col("reviews")).alias("r"), F.col("game")))["game"]
    oldest, newest = F.min(F.struct("released", "game"))["game"], F.max(F.struct("released", "game"))["game"]
    pct = F.when(F.col("lines") >= 20, ratio(F.col("good"), F.col("lines")))
    return j.groupBy("company").agg(
        F.count("*").alias("game_count"), F.sum("dev").alias("developed_count"), F.sum("pub").alias("published_count"), F.sum("reviews").alias("total_reviews"), rounded(F.avg(pct) * 100, 1).alias("average_positive"),
        rounded(ratio(F.sum("good"), F.sum("lines")) * 100, 1).alias("weighted_positive"), F.size(F.collect_set("tech")).cast("long").alias("technology_count"), F.array_join(F.array_sort(F.collect_set("tech")), "|").alias("technologies"),
        best.alias("most_reviewed"), oldest.alias("first_release"), newest.alias("latest_release"),
    )


TECH = f"""{GAMES}, j AS (SELECT p_brand AS tech, g.* FROM g JOIN part ON p_partkey = game)"""


def tech_games(t):
    return games(t).join(t.part.select(F.col("p_partkey").alias("game"), F.col("p_brand").alias("tech")), "game")


@query(
    "technology_statistics",
    f"""WITH {TECH}, d AS (SELECT p_brand AS tech, count(DISTINCT l_suppkey)::BIGINT AS developers FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT tech, count(*)::BIGINT AS game_count, developers, sum(reviews)::BIGINT AS reviews FROM j JOIN d USING (tech) GROUP BY tech, developers""",
)
def technology_statistics(t):
    # the distinct pairs first: a hot technology is then spread over its suppliers
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct().join(t.part.select("p_partkey", F.col("p_brand").alias("tech")), F.col("l_partkey") == F.col("p_partkey")).select("tech", "l_suppkey").distinct()
    return tech_games(t).groupBy("tech").agg(F.count("*").alias("game_count"), F.sum("reviews").alias("reviews")).join(pairs.groupBy("tech").agg(F.count("*").alias("developers")), "tech")


@query("technology_top_games", f"WITH {TECH} SELECT tech, game, reviews, rank FROM (SELECT *, row_number() OVER (PARTITION BY tech ORDER BY reviews DESC, game)::BIGINT AS rank FROM j WHERE reviews > 0) WHERE rank <= 10")
def technology_top_games(t):
    return top_by(tech_games(t).where("reviews > 0"), [F.col("reviews").desc(), F.col("game")], 10, ["tech"]).select("tech", "game", "reviews", "rank")


@query("technology_by_year", f"WITH {TECH} SELECT tech, substr(released, 1, 4) AS year, count(*)::BIGINT AS n FROM j WHERE released IS NOT NULL GROUP BY 1, 2")
def technology_by_year(t):
    return tech_games(t).where("released is not null").groupBy("tech", F.substring("released", 1, 4).alias("year")).agg(F.count("*").alias("n"))


PUBLISHED = f"""{GAMES}, e AS (SELECT DISTINCT s_nationkey AS publisher, l_partkey AS game FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)"""


def published(t):
    return t.lineitem.select("l_suppkey", F.col("l_partkey").alias("game")).distinct().join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("publisher")), "l_suppkey").select("publisher", "game").distinct()


@query(
    "publisher_statistics",
    f"""WITH {PUBLISHED} SELECT publisher, count(*)::BIGINT AS game_count, sum(reviews)::BIGINT AS reviews, first(game ORDER BY reviews DESC, game) AS top_game FROM e JOIN g USING (game) GROUP BY 1""",
)
def publisher_statistics(t):
    return published(t).join(games(t), "game").groupBy("publisher").agg(F.count("*").alias("game_count"), F.sum("reviews").alias("reviews"), F.min(F.struct((-F.col("reviews")).alias("r"), "game"))["game"].alias("top_game"))


@query(
    "publisher_timeline",
    f"""WITH {PUBLISHED} SELECT publisher, coalesce(CASE WHEN game % 7 <> 0 THEN substr(released, 1, 4) END, 'unknown') AS year, count(*)::BIGINT AS n, string_agg(game::VARCHAR, '|' ORDER BY game) AS games FROM e JOIN g USING (game) GROUP BY 1, 2""",
)
def publisher_timeline(t):
    year = F.coalesce(F.when(F.col("game") % 7 != 0, F.substring("released", 1, 4)), F.lit("unknown"))
    return published(t).join(games(t), "game").groupBy("publisher", year.alias("year")).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("game")), lambda g: g.cast("string")), "|").alias("games"))


@query("releases_by_year", "SELECT strftime(o_orderdate, '%Y') AS year, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1")
def releases_by_year(t):
    return t.orders.where(F.col("o_orderstatus").isin("F", "P")).groupBy(F.date_format("o_orderdate", "yyyy").alias("year")).agg(F.count("*").alias("n"))


TOTALS = ["part", "supplier", "nation", "customer", "orders", "lineitem", "events"]


@query("dataset_totals", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*)::BIGINT AS n FROM {n}" for n in TOTALS))
def dataset_totals(t):
    out = None
    for n in TOTALS:
        one = getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("grand_totals", "SELECT sum(l_quantity)::BIGINT AS reviews, count(DISTINCT l_partkey)::BIGINT AS games FROM lineitem")
def grand_totals(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")).agg(F.sum("q").cast("long").alias("reviews"), F.count("*").alias("games"))


@query(
    "history_thinning",
    """WITH p AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS day FROM orders), c AS (SELECT max(day) - 400 AS cut FROM p)
    SELECT o_custkey, day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, strftime(day, '%Y-%m'), day < cut ORDER BY day) AS n FROM p, c) WHERE day >= cut OR n = 1""",
)
def history_thinning(t):
    points = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day")).distinct()
    newest = points.agg(F.max("day").alias("today"))
    return thinned_history(points.crossJoin(F.broadcast(newest)), "o_custkey", "day", F.col("today")).select("o_custkey", "day")


@query(
    "observation_upsert",
    """WITH p AS (SELECT user_id, event_id, ts::DATE AS day, value, max(ts::DATE) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM events)
    SELECT user_id, day, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY event_id DESC) AS n FROM p WHERE last IS NULL OR day >= last) WHERE n = 1""",
)
def observation_upsert(t):
    points = t.events.select("user_id", "event_id", F.col("ts").cast("date").alias("day"), "value")
    return observations(points, "user_id", "day", "event_id").select("user_id", "day", "event_id", "value")


@query(
    "streaming_history",
    """WITH p AS (SELECT user_id, day, event_id, value FROM (SELECT user_id, ts::DATE AS day, event_id, value, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id DESC, value DESC NULLS LAST) AS n FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_id IS NOT NULL) WHERE n = 1),
    c AS (SELECT max(day) - 10 AS cut FROM p)
    SELECT user_id, day, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, strftime(day, '%Y-%m'), day < cut ORDER BY day) AS n FROM p, c) WHERE day >= cut OR n = 1""",
)
def streaming_history(t):
    from ferrule.streaming import history
    from ferrule.streaming.observations import SCHEMA

    folder = shared_folder(t.spark)
    events = t.spark.readStream.schema(SCHEMA).parquet(f"{t.folder}/events.parquet*")
    points = events.select(F.col("user_id").alias("key"), F.col("ts").cast("date").alias("day"), F.col("event_id").alias("ordinal"), "value")
    sink = history.run(t.spark, points, f"{folder}/points", f"{folder}/offsets", days=10, lateness="2 days")
    return history.history(sink, days=10).withColumnRenamed("key", "user_id").withColumnRenamed("ordinal", "event_id")


@query(
    "lifetime_average",
    """WITH o AS (SELECT o_custkey, count(*) AS n, min(strftime(o_orderdate, '%Y-%m')) AS month FROM orders GROUP BY 1)
    SELECT o_custkey, floor(n / greatest(1.0, (DATE '2001-09-01' - (month || '-01')::DATE)::DOUBLE) * 30.44 * 10.0 + 0.5) / 10.0 AS per_month FROM o""",
)
def lifetime_average(t):
    from ferrule.functions.columns import days_since

    o = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.min(F.date_format("o_orderdate", "yyyy-MM")).alias("month"))
    days = F.greatest(F.lit(1.0), days_since(F.col("month"), F.lit("2001-09-01").cast("timestamp_ntz")))
    return o.select("o_custkey", rounded(F.col("n") / days * 30.44, 1).alias("per_month"))


@query(
    "technologies_of_bag",
    """WITH b AS (SELECT l_suppkey AS company, l_partkey AS game FROM lineitem WHERE l_linenumber % 2 = 1 UNION ALL SELECT l_suppkey, l_partkey FROM lineitem WHERE l_linenumber % 2 = 0)
    SELECT company, p_brand AS tech, count(*)::BIGINT AS n FROM b JOIN part ON p_partkey = game GROUP BY 1, 2""",
)
def technologies_of_bag(t):
    e, odd = t.lineitem.select(F.col("l_suppkey").alias("company"), F.col("l_partkey").alias("p_partkey"), "l_linenumber"), F.col("l_linenumber") % 2 == 1
    bag = e.where(odd).unionAll(e.where(~odd))
    return bag.join(t.part.select("p_partkey", F.col("p_brand").alias("tech")), "p_partkey").groupBy("company", "tech").agg(F.count("*").alias("n"))


@query(
    "credit_roles",
    """SELECT l_partkey AS game, l_suppkey AS company, string_agg(DISTINCT CASE l_linenumber % 3 WHEN 0 THEN 'developer' WHEN 1 THEN 'publisher' ELSE 'porting' END, '|' ORDER BY CASE l_linenumber % 3 WHEN 0 THEN 'developer' WHEN 1 THEN 'publisher' ELSE 'porting' END) AS roles FROM lineitem GROUP BY 1, 2""",
)
def credit_roles(t):
    k = F.col("l_linenumber") % 3
    role = F.when(k == 0, "developer").when(k == 1, "publisher").otherwise("porting")
    return t.lineitem.groupBy(F.col("l_partkey").alias("game"), F.col("l_suppkey").alias("company")).agg(F.array_join(F.array_sort(F.collect_set(role)), "|").alias("roles"))


@query(
    "build_series",
    """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS label, count(*) AS n FROM orders GROUP BY 1)
    SELECT label, n::BIGINT AS added, sum(n) OVER (ORDER BY label)::BIGINT AS total FROM m""",
)
def build_series(t):
    months = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("label")).agg(F.count("*").alias("added"))
    return months.withColumn("total", F.sum("added").over(Window.orderBy("label")))  # one row per month


@query(
    "snapshot_index",
    """WITH s AS (SELECT strftime(o_orderdate, '%Y-%m') AS label, o_orderkey AS build, o_totalprice AS size FROM orders)
    SELECT label, build, size FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY build DESC) AS n FROM s) WHERE n = 1""",
)
def snapshot_index(t):
    s = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("label"), F.col("o_orderkey").alias("build"), F.col("o_totalprice").alias("size"))
    return s.groupBy("label").agg(F.max(F.struct("build", "size")).alias("m")).select("label", "m.build", "m.size")


@query(
    "observed_names",
    "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS names FROM customer GROUP BY 1",
)
def observed_names(t):
    return t.customer.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "|").alias("names"))


@query(
    "dedupe_sources",
    """SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
)
def dedupe_sources(t):
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.max("o_orderkey").alias("o_orderkey"))


@query("used_sources", "SELECT DISTINCT event_type AS source, 'licence of ' || event_type AS licence FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'login')")
def used_sources(t):
    known = t.spark.createDataFrame([(x, f"licence of {x}") for x in ("click", "view", "purchase", "signup", "login")], "source string, licence string")
    return t.events.select(F.col("event_type").alias("source")).distinct().join(F.broadcast(known), "source")


@query(
    "first_release_rows",
    "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1",
)
def first_release_rows(t):
    return first_by(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")
