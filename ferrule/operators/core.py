"""Relational operators that the plans share; every one takes and returns DataFrames."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.functions.columns import rounded

DAYS_A_MONTH = 30.44


def top_by(df: DataFrame, order: Sequence[Column], k: int, within: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """The first k rows, of each group if there are group columns, with their rank from 1.

    Without groups the limit comes before the numbering, so that only k rows of each partition are kept and compared.
    """
    if within:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)).cast("long")).where(F.col(name) <= k)
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each group, the first in order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    return first_by(df, keys, [F.col(ordinal).desc()])


def priority_pick(records: DataFrame, keys: Sequence[str], value: str, rank: str, ordinal: str) -> DataFrame:
    """Per key the first non-blank value by rank and then ordinal, its rank, and the later values that differ, joined.

    Aggregates structs, so each provider's rows combine before they are shuffled.
    """
    kept = records.where(F.col(value).isNotNull() & (F.col(value) != "") & F.col(rank).isNotNull())
    listed = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(rank, ordinal, value))).alias("_all"))
    picked = listed.withColumn("_first", F.get("_all", 0))
    others = F.array_distinct(F.transform(F.filter("_all", lambda x: x[value] != F.col("_first")[value]), lambda x: x[value]))
    return picked.select(*keys, F.col("_first")[value].alias(value), F.col("_first")[rank].alias(rank), others.alias("alternatives"))


def sorted_union(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Per key the distinct values, sorted."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(name))


def inclusion(rows: DataFrame, key: str, edges: DataFrame, chosen: DataFrame, by: str) -> DataFrame:
    """Rows with at least one edge to a chosen row (a semi-join through the edge list)."""
    return rows.join(edges.join(chosen, by, "left_semi").select(key), key, "left_semi")


def thinned_history(points: DataFrame, key: str, date: str, today: Column, days: int = 400) -> DataFrame:
    """All points of the last `days` days and the first of each month before."""
    old = F.col(date) < F.date_sub(today, days)
    first = F.row_number().over(Window.partitionBy(key, F.date_format(date, "yyyy-MM"), old).orderBy(date))
    return points.withColumn("_n", F.when(old, first).otherwise(1)).where("_n = 1").drop("_n")


def observations(points: DataFrame, key: str, date: str, ordinal: str) -> DataFrame:
    """Appends in order of ordinal: a point of the last day replaces it, an older one is dropped.

    A point counts if no earlier one has a later date; of a day's points the last counts.
    """
    so_far = Window.partitionBy(key).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
    kept = points.withColumn("_last", F.max(date).over(so_far)).where(F.col("_last").isNull() | (F.col(date) >= F.col("_last"))).drop("_last")
    return last_wins(kept, [key, date], ordinal)


def velocity(points: DataFrame, key: str, day: str, total: str, window_days: int, least_span: int = 7) -> DataFrame:
    """Per key the growth between the newest point and the newest one at least window_days older, else the oldest.

    day is a day number; a span below least_span gives nulls in all but observations. Two aggregations over one
    partitioning by key; no window has to hold a key's whole history.
    """
    latest = points.groupBy(key).agg(F.max(F.struct(day, total)).alias("latest"), F.min(F.struct(day, total)).alias("oldest"), F.count("*").alias("observations"))
    base = points.join(latest.select(key, F.col("latest")[day].alias("_day")), key).where(F.col(day) <= F.col("_day") - window_days).groupBy(key).agg(F.max(F.struct(day, total)).alias("older"))
    both = latest.join(base, key, "left").withColumn("base", F.coalesce("older", "oldest"))
    span = F.col("latest")[day] - F.col("base")[day]
    delta = F.col("latest")[total] - F.col("base")[total]
    ok = (F.col("observations") >= 2) & (span >= least_span)
    per_day = F.when(ok, F.greatest(F.lit(0.0), delta.cast("double")) / span)
    return both.select(
        key,
        rounded(per_day, 2).alias("per_day"),
        rounded(per_day * DAYS_A_MONTH, 1).alias("per_month"),
        F.when(ok, span.cast("long")).alias("window_days"),
        F.when(ok, delta).alias("growth"),
        F.when(ok & (F.col("base")[total] > 0), rounded(delta / F.col("base")[total] * 100, 2)).alias("growth_percent"),
        F.col("observations").cast("long").alias("observations"),
    )


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One row per key and field that differs between two snapshots, null-safe; keys of one side only are left out."""
    old = before.select(key, *(F.col(f).cast("string").alias(f"_old_{f}") for f in fields))
    new = after.select(key, *(F.col(f).cast("string").alias(f"_new_{f}") for f in fields))
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"_old_{f}").alias("old_value"), F.col(f"_new_{f}").alias("new_value")) for f in fields))
    changed = F.filter(pairs, lambda x: ~x["old_value"].eqNullSafe(x["new_value"]))
    return old.join(new, key).select(key, F.explode(changed).alias("c")).select(key, "c.*")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node reachable over the edges (a, b), by min-label propagation with pointer jumping.

    Each round halves the distance to the root; the labels are cut from their lineage by checkpoint() where the
    session has a checkpoint folder.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b").distinct()
    labels = cut(spark, both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"))
    for _ in range(rounds):
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("heard"))
        told = labels.join(heard, labels["node"] == heard["a"]).select("node", "root", F.least("root", "heard").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        moved = cut(spark, told.join(jump, "near").select("node", "root", F.least("near", "far").alias("next")))
        labels = moved.select("node", F.col("next").alias("root"))
        if moved.where("root <> next").isEmpty():
            return labels
    raise RuntimeError("components did not converge")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the session's checkpoint folder, or below one of our own where none is set (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ferrule-"))
        top = spark.sparkContext.getCheckpointDir()
    return f"{top.rstrip('/')}/ferrule-{uuid.uuid4().hex}"


def cut(spark: SparkSession, df: DataFrame) -> DataFrame:
    """df without its lineage, checkpointed where all executors can read it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position", parts: int | None = None) -> DataFrame:
    """df with its place from 1 in the order of all rows; no task sees more than its range of the order.

    Rows are dealt by range and written with the number of their part, as another run of the same plan may draw other
    boundaries; a part's rows are numbered by themselves, on top of how many the parts before it have.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(spark, df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    ahead = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    placed = dealt.withColumn("_own", F.row_number().over(Window.partitionBy("_part").orderBy(*order))).join(F.broadcast(ahead), "_part")
    return placed.withColumn(name, (F.col("_ahead") + F.col("_own")).cast("long")).drop("_part", "_own", "_ahead")


def running(df: DataFrame, key: str, order: Sequence[str], parts: int | None = None, **made: tuple[str, Column]) -> DataFrame:
    """df with running sums or maxima (name=("sum" or "max", column)) over the rows of a key up to each row, in an order that
    has no ties.

    A key of any number of rows is spread over parts, dealt by range of key and order and written with the number of
    their part. A part's rows run by themselves; what a key has in the parts before is added on top. Only keys that lie
    in several parts have such, so that the table of it has fewer rows than twice the parts.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = df.withColumns({f"_{n}": c for n, (_, c) in made.items()})
    dealt = cut(df.sparkSession, whole.repartitionByRange(parts, key, *order).withColumn("_part", F.spark_partition_id()))
    of = {"sum": F.sum, "max": F.max}
    ends = dealt.groupBy("_part").agg(F.min(key).alias("least"), F.max(key).alias("most"))
    edges = ends.select(F.explode(F.array("least", "most")).alias(key)).distinct()
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.join(F.broadcast(edges), key).groupBy("_part", key).agg(*(of[f](f"_{n}").alias(n) for n, (f, _) in made.items()))
    ahead = totals.select("_part", key, *(of[f](n).over(before).alias(f"_{n}_ahead") for n, (f, _) in made.items()))
    own = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = dealt.withColumns({n: of[f](f"_{n}").over(own) for n, (f, _) in made.items()}).join(F.broadcast(ahead), ["_part", key], "left")
    both = {n: F.coalesce(F.col(f"_{n}_ahead"), F.lit(0)) + F.col(n) if f == "sum" else F.greatest(f"_{n}_ahead", n) for n, (f, _) in made.items()}
    return found.withColumns(both).drop("_part", *(f"_{n}{x}" for n in made for x in ("", "_ahead")))


def content_digest(rows: DataFrame, line: Column) -> DataFrame:
    """(records, bytes, sha256) of the lines of a table, whatever their order.

    Each line's SHA-256 counts as four numbers of 60 bits; their sums over all lines, which add up in any order and in
    any number of tasks, are hashed once more.
    """
    digest = F.sha2(line, 256)
    sums = [F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")) for at in (1, 16, 31, 46)]
    found = rows.agg(F.count("*").alias("records"), F.coalesce(F.sum(F.octet_length(line)), F.lit(0)).alias("bytes"), *(F.coalesce(x, F.lit(0)).alias(f"s{i}") for i, x in enumerate(sums)))
    return found.select("records", "bytes", F.sha2(F.concat_ws(":", F.col("records").cast("string"), *(F.col(f"s{i}").cast("string") for i in range(4))), 256).alias("sha256"))


def joined_text(values: Column, separator: str = "|") -> Column:
    return F.array_join(values, separator)
