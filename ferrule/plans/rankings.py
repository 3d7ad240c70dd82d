"""Rankings: parts are the games, line items their reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.functions.columns import ratio, rounded
from ferrule.operators.core import top_by, velocity
from ferrule.plans.base import query

K, WINDOW, LEAST_LINES = 25, 10, 20

MOST = """SELECT row_number() OVER (ORDER BY value DESC, l_partkey)::BIGINT AS rank, l_partkey AS id, value FROM (
  SELECT l_partkey, {value} AS value FROM lineitem GROUP BY 1) WHERE value > 0 ORDER BY value DESC, l_partkey LIMIT 25"""


def most(t, value):
    totals = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(value.alias("value")).where("value > 0")
    return top_by(totals, [F.col("value").desc(), F.col("id")], K).select("rank", "id", "value")


@query("rank_most_reviewed", MOST.format(value="sum(l_quantity::BIGINT)::BIGINT"))
def rank_most_reviewed(t):
    return most(t, F.sum(F.col("l_quantity").cast("long")))


@query("rank_most_played", MOST.format(value="sum(CASE WHEN l_tax > 0.04 THEN 1 ELSE NULL END)::BIGINT"))
def rank_most_played(t):
    return most(t, F.sum(F.when(F.col("l_tax") > 0.04, 1)))


SHARES = """s AS (SELECT l_partkey AS id, count(*) AS lines, count(*) FILTER (l_returnflag = 'N') AS good FROM lineitem GROUP BY 1)"""


@query(
    "rank_highest_rated",
    f"""WITH {SHARES}, p AS (SELECT id, lines, floor(good::DOUBLE / lines::DOUBLE * 1000.0 + 0.5) / 10.0 AS pct FROM s WHERE lines >= 20)
    SELECT row_number() OVER (ORDER BY pct DESC, lines DESC, id)::BIGINT AS rank, id, pct, lines::BIGINT AS lines FROM p ORDER BY 1 LIMIT 25""",
)
def rank_highest_rated(t):
    s = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(F.count("*").alias("lines"), F.count_if(F.col("l_returnflag") == "N").alias("good")).where(F.col("lines") >= LEAST_LINES)
    s = s.withColumn("pct", rounded(ratio(F.col("good"), F.col("lines")) * 100, 1))
    return top_by(s, [F.col("pct").desc(), F.col("lines").desc(), F.col("id")], K).select("rank", "id", "pct", "lines")


PARTIAL = """d AS (SELECT o_orderkey AS id, o_totalprice AS price, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y') END AS date FROM orders)"""


def partial_dates(t):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    date = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, F.date_format(d, "yyyy"))
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), date.alias("date"))


@query("rank_most_recent", f"WITH {PARTIAL} SELECT row_number() OVER (ORDER BY date DESC, id)::BIGINT AS rank, id, date FROM d WHERE date IS NOT NULL ORDER BY date DESC, id LIMIT 25")
def rank_most_recent(t):
    return top_by(partial_dates(t).where("date is not null"), [F.col("date").desc(), F.col("id")], K).select("rank", "id", "date")


@query("rank_most_established", f"WITH {PARTIAL} SELECT row_number() OVER (ORDER BY date, id)::BIGINT AS rank, id, date FROM d WHERE date IS NOT NULL AND price >= 1000 ORDER BY date, id LIMIT 25")
def rank_most_established(t):
    return top_by(partial_dates(t).where("date is not null and price >= 1000"), [F.col("date"), F.col("id")], K).select("rank", "id", "date")


def daily_totals(t):
    """Cumulative number of events per user and day."""
    from pyspark.sql import Window

    days = t.events.groupBy("user_id", F.unix_date(F.col("ts").cast("date")).alias("day")).agg(F.count("*").alias("n"))
    return days.select("user_id", "day", F.sum("n").over(Window.partitionBy("user_id").orderBy("day")).alias("total"))


DAILY = """p AS (SELECT user_id, day, sum(n) OVER (PARTITION BY user_id ORDER BY day)::BIGINT AS total FROM (
  SELECT user_id, (ts::DATE - DATE '1970-01-01')::BIGINT AS day, count(*) AS n FROM events GROUP BY 1, 2))"""
VELOCITY = f"""{DAILY}, l AS (SELECT user_id, max(day) AS last, min(day) AS first, count(*) AS observations FROM p GROUP BY 1),
  b AS (SELECT p.user_id, max(p.day) AS day FROM p JOIN l ON p.user_id = l.user_id WHERE p.day <= l.last - 10 GROUP BY 1),
  v AS (SELECT l.user_id, l.observations, l.last - coalesce(b.day, l.first) AS span, e.total - o.total AS delta, o.total AS base
    FROM l LEFT JOIN b USING (user_id) JOIN p AS e ON e.user_id = l.user_id AND e.day = l.last JOIN p AS o ON o.user_id = l.user_id AND o.day = coalesce(b.day, l.first)),
  w AS (SELECT *, observations >= 2 AND span >= 7 AS ok, CASE WHEN observations >= 2 AND span >= 7 THEN greatest(0.0, delta::DOUBLE) / span END AS per FROM v)"""


@query(
    "review_velocity",
    f"""WITH {VELOCITY} SELECT user_id, floor(per * 100.0 + 0.5) / 100.0 AS per_day, floor(per * 30.44 * 10.0 + 0.5) / 10.0 AS per_month,
      CASE WHEN ok THEN span END::BIGINT AS window_days, CASE WHEN ok THEN delta END::BIGINT AS growth,
      CASE WHEN ok AND base > 0 THEN floor(delta / base::DOUBLE * 100 * 100.0 + 0.5) / 100.0 END AS growth_percent, observations::BIGINT AS observations FROM w""",
)
def review_velocity(t):
    return velocity(daily_totals(t), "user_id", "day", "total", WINDOW)


@query(
    "rank_recently_popular",
    f"""WITH {VELOCITY}, r AS (SELECT user_id AS id, floor(per * 100.0 + 0.5) / 100.0 AS value, ok FROM w),
      pool AS (SELECT * FROM r WHERE ok OR NOT EXISTS (SELECT 1 FROM r WHERE ok))
      SELECT row_number() OVER (ORDER BY value DESC, id)::BIGINT AS rank, id, value FROM pool WHERE value > 0 ORDER BY value DESC, id LIMIT 25""",
)
def rank_recently_popular(t):
    v = velocity(daily_totals(t), "user_id", "day", "total", WINDOW).select(F.col("user_id").alias("id"), F.col("per_day").alias("value"), F.col("window_days").isNotNull().alias("measured"))
    some = v.agg(F.coalesce(F.max("measured"), F.lit(False)).alias("some"))
    pool = v.crossJoin(F.broadcast(some)).where("measured or not some and value > 0").where("value > 0")  # one row
    return top_by(pool, [F.col("value").desc(), F.col("id")], K).select("rank", "id", "value")


@query(
    "anchored_recent",
    "SELECT count(*)::BIGINT AS n, count(DISTINCT o_custkey)::BIGINT AS customers FROM orders WHERE o_orderdate::DATE > (SELECT max(o_orderdate)::DATE - 30 FROM orders)",
)
def anchored_recent(t):
    newest = t.orders.agg(F.max(F.col("o_orderdate").cast("date")).alias("newest"))
    return t.orders.crossJoin(F.broadcast(newest)).where(F.col("o_orderdate").cast("date") > F.date_sub("newest", 30)).agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))
