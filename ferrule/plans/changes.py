"""Comparison of builds: added, removed and changed rows, review candidates, stamps and hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.operators.core import content_digest, snapshot_changes, top_by
from ferrule.plans.base import digest_sql, query

SNAPSHOTS = """a AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01' AND o_orderkey % 50 <> 0), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderdate <= TIMESTAMP '2001-01-01' AND o_orderkey % 60 <> 0)"""


def snapshots(t):
    k = F.col("o_orderkey")
    a = t.orders.where((F.col("o_orderdate") <= F.lit("2000-01-01").cast("timestamp_ntz")) & (k % 50 != 0))
    b = t.orders.where((F.col("o_orderdate") <= F.lit("2001-01-01").cast("timestamp_ntz")) & (k % 60 != 0))
    b = b.withColumns({"o_orderstatus": F.when(k % 9 == 0, "X").otherwise(F.col("o_orderstatus")), "o_totalprice": F.when(k % 11 == 0, F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice")), "o_orderpriority": F.when(k % 13 != 0, F.col("o_orderpriority"))})
    return a, b


@query("snapshot_added_removed", f"WITH {SNAPSHOTS} SELECT o_orderkey AS id, 'added' AS change FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a) UNION ALL SELECT o_orderkey, 'removed' FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)")
def snapshot_added_removed(t):
    a, b = (x.select(F.col("o_orderkey").alias("id")) for x in snapshots(t))
    return b.join(a, "id", "left_anti").withColumn("change", F.lit("added")).unionByName(a.join(b, "id", "left_anti").withColumn("change", F.lit("removed")))


FIELDS = ("o_orderstatus", "o_orderpriority")


@query(
    "snapshot_field_changes",
    f"WITH {SNAPSHOTS} " + " UNION ALL ".join(f"SELECT a.o_orderkey, '{f}' AS field, a.{f} AS old_value, b.{f} AS new_value FROM a JOIN b USING (o_orderkey) WHERE a.{f} IS DISTINCT FROM b.{f}" for f in FIELDS),
)
def snapshot_field_changes(t):
    return snapshot_changes(*snapshots(t), "o_orderkey", FIELDS)


@query("review_count_changes", f"WITH {SNAPSHOTS} SELECT a.o_orderkey AS id, floor((b.o_totalprice - a.o_totalprice) * 100.0 + 0.5) / 100.0 AS delta, row_number() OVER (ORDER BY abs(floor((b.o_totalprice - a.o_totalprice) * 100.0 + 0.5)) DESC, a.o_orderkey)::BIGINT AS position FROM a JOIN b USING (o_orderkey) WHERE a.o_totalprice <> b.o_totalprice ORDER BY position LIMIT 30")
def review_count_changes(t):
    a, b = snapshots(t)
    delta = F.floor((F.col("new") - F.col("old")) * 100.0 + 0.5) / 100.0
    both = a.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("old")).join(b.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("new")), "id").where("old <> new")
    return top_by(both.select("id", delta.alias("delta")), [F.abs("delta").desc(), F.col("id")], 30, name="position").select("id", "delta", "position")


CANDIDATES = f"""{SNAPSHOTS}, c AS (
  SELECT 'new-game' AS category, b.o_orderkey::VARCHAR AS subject, b.o_orderkey::VARCHAR AS key FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
  UNION ALL SELECT 'relationship-change', b.o_orderkey::VARCHAR, a.o_orderstatus || '>' || b.o_orderstatus FROM a JOIN b USING (o_orderkey) WHERE a.o_orderstatus <> b.o_orderstatus
  UNION ALL SELECT 'source-conflict', b.o_custkey::VARCHAR, 'customer' FROM b WHERE o_orderkey % 97 = 0),
  i AS (SELECT DISTINCT category || ':' || subject || ':' || substr(sha256(key), 1, 12) AS id, category FROM c)"""


def candidates_of(t):
    a, b = snapshots(t)
    text = F.col("o_orderkey").cast("string")
    old = a.select("o_orderkey", F.col("o_orderstatus").alias("before"))
    new = b.join(a, "o_orderkey", "left_anti").select(F.lit("new-game").alias("category"), text.alias("subject"), text.alias("key"))
    changed = b.join(old, "o_orderkey").where("before <> o_orderstatus").select(F.lit("relationship-change").alias("category"), text.alias("subject"), F.concat("before", F.lit(">"), "o_orderstatus").alias("key"))
    conflict = b.where("o_orderkey % 97 = 0").select(F.lit("source-conflict").alias("category"), F.col("o_custkey").cast("string").alias("subject"), F.lit("customer").alias("key"))
    every = new.unionByName(changed).unionByName(conflict)
    return every.select(F.concat_ws(":", "category", "subject", F.substring(F.sha2("key", 256), 1, 12)).alias("id"), "category").distinct()


@query("candidates", f"WITH {CANDIDATES} SELECT id, category FROM i")
def candidates(t):
    return candidates_of(t)


@query("undecided", f"WITH {CANDIDATES} SELECT id FROM i WHERE id NOT IN (SELECT id FROM i WHERE category = 'source-conflict' OR substr(sha256(id), 1, 1) < '8')")
def undecided(t):
    every = candidates_of(t)
    decided = every.where((F.col("category") == "source-conflict") | (F.substring(F.sha2("id", 256), 1, 1) < "8")).select("id")
    return every.join(decided, "id", "left_anti").select("id")


@query("candidate_counts", f"WITH {CANDIDATES} SELECT category, count(*)::BIGINT AS n FROM i GROUP BY 1")
def candidate_counts(t):
    return candidates_of(t).groupBy("category").agg(F.count("*").alias("n"))


@query(
    "last_updated_stamp",
    """WITH n AS (SELECT s_suppkey AS id, sha256(s_name || '|' || s_nationkey) AS hash FROM supplier), p AS (SELECT s_suppkey AS id, sha256(CASE WHEN s_suppkey % 5 = 0 THEN 'old' ELSE s_name END || '|' || s_nationkey) AS hash, '2025-12-' || lpad((1 + s_suppkey % 28)::VARCHAR, 2, '0') AS stamp FROM supplier WHERE s_suppkey % 9 <> 0)
    SELECT n.id, CASE WHEN n.hash = p.hash THEN p.stamp ELSE '2026-01-16' END AS last_updated FROM n LEFT JOIN p USING (id)""",
)
def last_updated_stamp(t):
    k = F.col("s_suppkey")

    def digest(name):
        return F.sha2(F.concat_ws("|", name, F.col("s_nationkey").cast("string")), 256)

    now = t.supplier.select(k.alias("id"), digest(F.col("s_name")).alias("hash"))
    before = t.supplier.where(k % 9 != 0).select(k.alias("id"), digest(F.when(k % 5 == 0, "old").otherwise(F.col("s_name"))).alias("old"), F.concat(F.lit("2025-12-"), F.lpad((1 + k % 28).cast("string"), 2, "0")).alias("stamp"))
    return now.join(before, "id", "left").select("id", F.when(F.col("hash") == F.col("old"), F.col("stamp")).otherwise("2026-01-16").alias("last_updated"))


@query("content_hash", digest_sql("SELECT s_suppkey || ':' || sha256(s_name) AS line FROM supplier"))
def content_hash(t):
    return content_digest(t.supplier, F.concat_ws(":", F.col("s_suppkey").cast("string"), F.sha2("s_name", 256)))


@query("low_confidence_claims", "SELECT game, tech, confidence FROM (SELECT p_partkey AS game, p_brand AS tech, CASE WHEN p_size % 2 = 0 THEN 'low' ELSE 'high' END AS confidence, CASE WHEN p_partkey % 3 = 0 THEN 'low' WHEN p_partkey % 3 = 1 THEN 'high' END AS before FROM part) WHERE confidence NOT IN ('verified', 'high') AND confidence IS DISTINCT FROM before")
def low_confidence_claims(t):
    k = F.col("p_partkey")
    now = t.part.select(k.alias("game"), F.col("p_brand").alias("tech"), F.when(F.col("p_size") % 2 == 0, "low").otherwise("high").alias("confidence"))
    before = t.part.where(k % 3 != 2).select(k.alias("game"), F.col("p_brand").alias("tech"), F.when(k % 3 == 0, "low").otherwise("high").alias("before"))
    return now.join(before, ["game", "tech"], "left").where(~F.col("confidence").isin("verified", "high") & ~F.col("confidence").eqNullSafe(F.col("before"))).select("game", "tech", "confidence")


@query("output_diff", "SELECT coalesce(a.k, b.k) AS path, CASE WHEN a.k IS NULL THEN 'missing' WHEN b.k IS NULL THEN 'extra' ELSE 'differs' END AS state FROM (SELECT s_suppkey AS k, s_name AS v FROM supplier WHERE s_suppkey % 4 <> 0) AS a FULL JOIN (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 6 = 0 THEN 'x' ELSE s_name END AS v FROM supplier WHERE s_suppkey % 5 <> 0) AS b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v")
def output_diff(t):
    k = F.col("s_suppkey")
    a = t.supplier.where(k % 4 != 0).select(k.alias("path"), F.sha2("s_name", 256).alias("old"))
    b = t.supplier.where(k % 5 != 0).select(k.alias("path"), F.sha2(F.when(k % 6 == 0, "x").otherwise(F.col("s_name")), 256).alias("new"))
    return a.join(b, "path", "full").where(~F.col("old").eqNullSafe(F.col("new"))).select("path", F.when(F.col("old").isNull(), "missing").when(F.col("new").isNull(), "extra").otherwise("differs").alias("state"))


#: What a decision edits, by category and action; other approvals are only logged.
EFFECTS = {
    ("new-game", "reject"): "exclude", ("new-game", "merge"): "mapping", ("new-game", "edit"): "override",
    ("relationship-change", "reject"): "inverse relationship override", ("source-conflict", "edit"): "override",
    ("source-conflict", "merge"): "mapping",
}
ACTIONS = ("approve", "reject", "merge", "edit")
_EFFECT_SQL = "CASE " + " ".join(f"WHEN category = '{c}' AND action = '{a}' THEN '{e}'" for (c, a), e in EFFECTS.items()) + " ELSE 'log' END"


@query("decision_effects", f"WITH {CANDIDATES}, d AS (SELECT id, category, (['approve', 'reject', 'merge', 'edit'])[1 + ('0x' || substr(sha256(id), 1, 2))::INT % 4] AS action FROM i) SELECT id, action, {_EFFECT_SQL} AS effect FROM d")
def decision_effects(t):
    digest = F.conv(F.substring(F.sha2("id", 256), 1, 2), 16, 10).cast("int")
    decided = candidates_of(t).withColumn("action", F.get(F.array(*(F.lit(a) for a in ACTIONS)), digest % 4))
    effects = t.spark.createDataFrame([(c, a, e) for (c, a), e in EFFECTS.items()], "category string, action string, effect string")
    return decided.join(F.broadcast(effects), ["category", "action"], "left").select("id", "action", F.coalesce("effect", F.lit("log")).alias("effect"))  # a fixed table of a few rows


@query(
    "report_sections",
    f"""WITH {CANDIDATES}, n AS (SELECT category, id, row_number() OVER (PARTITION BY category ORDER BY id) AS k, count(*) OVER (PARTITION BY category) AS total FROM i)
    SELECT category, k::BIGINT AS position, '* ' || id AS line FROM n WHERE k <= 15 UNION ALL SELECT DISTINCT category, 16, '* and ' || (total - 15) || ' more' FROM n WHERE total > 15""",
)
def report_sections(t):
    every = candidates_of(t)
    first = top_by(every, [F.col("id")], 15, ["category"], name="position").select("category", "position", F.concat(F.lit("* "), "id").alias("line"))
    rest = every.groupBy("category").agg(F.count("*").alias("n")).where("n > 15")
    return first.unionByName(rest.select("category", F.lit(16).cast("long").alias("position"), F.format_string("* and %d more", F.col("n") - 15).alias("line")))
