"""Ids that are readable, unique and stable, given to many things at once.

One after another, in order, each thing would take the first of its candidates that nobody has. All at once the same ids
come out of rounds of proposals: everybody proposes the next candidate that may be free, the first in order holds an id
until someone before it proposes it too, and whoever lost goes on. What a thing lost it lost to someone before it, so
that nobody ever has to go back.

Ids that differ only by numbers at their ends are a family, and families don't meet. One of few things is done one after
another in one task; rounds are for larger ones, and for things whose candidates lie in several.

Things of one name go on to counters. As they take them in their order, the one that has k of them before it skips k
counters at once; so a round settles a name however many share it, and only counters that others hold cost a round more.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.operators import core


#: Things of a family at most that one task goes through; results don't depend on it.
FAMILY = 10_000


def _stem() -> Column:
    return F.regexp_extract("id", r"^(.+)-([1-9][0-9]{0,8})$", 1)


def _number() -> Column:
    return F.nullif(F.regexp_extract("id", r"^(.+)-([1-9][0-9]{0,8})$", 2), F.lit("")).cast("long")


def _counters(waiting: DataFrame, blocked: DataFrame) -> DataFrame:
    """waiting (key, stem, low) with n: by key the first counters of the stem from low on that aren't blocked (stem, n),
    each above that of the one before.

    Counted among the counters that aren't blocked, a thing's place is the largest of what its low asks for and one more
    than the place before it.
    """
    spark = waiting.sparkSession
    some = core.cut(spark, blocked.join(waiting.select("stem").distinct(), "stem", "left_semi").where("n >= 2").distinct())
    apart = some.isEmpty()  # then counters and places are the same numbers
    asks = waiting.select("stem", F.col("low").alias("value"), F.lit(0).alias("kind"), "key", "low").unionByName(some.select("stem", F.col("n").alias("value"), F.lit(1).alias("kind")), allowMissingColumns=True)
    counted = asks.withColumn("below", F.lit(0)) if apart else core.running(asks, "stem", ["value", "kind", "key"], below=("sum", F.col("kind"))).where("kind = 0")
    free = counted.select("key", "stem", "low", (F.col("low") - 2 - F.col("below")).alias("free"))
    ranked = core.running(free, "stem", ["key"], rank=("sum", F.lit(1)))
    placed = core.running(ranked, "stem", ["key"], most=("max", F.col("free") - F.col("rank"))).withColumn("place", F.col("rank") + F.col("most"))
    if apart:
        return core.cut(spark, placed.select("key", "stem", "low", (F.col("place") + 2).alias("n")))
    number = core.running(some, "stem", ["n"], nth=("sum", F.lit(1))).select("stem", (F.col("n") - 1 - F.col("nth")).alias("value"), F.lit(0).alias("kind"))
    asks = placed.select("stem", F.col("place").alias("value"), F.lit(1).alias("kind"), "key", "low", "place").unionByName(number, allowMissingColumns=True)
    found = core.running(asks, "stem", ["value", "kind", "key"], below=("sum", 1 - F.col("kind"))).where("kind = 1")
    return core.cut(spark, found.select("key", "stem", "low", (F.col("place") + 2 + F.col("below")).alias("n")))


def _family(id_: Column) -> Column:
    return F.regexp_replace(id_, r"(?:-[0-9]+)+$", "")


def _in_order(things: pa.Table, taken: pa.Table) -> pa.Table:
    """Ids of a whole family, one thing after another."""
    had, counters, ids = set(taken.column("id").to_pylist()), {}, []
    things = things.sort_by("key")
    for names in things.column("candidates").to_pylist():
        found = next((n for n in names if n not in had), None)
        if found is None:
            n = counters.get(names[0], 2)
            while (found := f"{names[0]}-{n}") in had:
                n += 1
            counters[names[0]] = n
        had.add(found)
        ids.append(found)
    return pa.table({"key": things.column("key"), "id": pa.array(ids, pa.string())})


def allocate(things: DataFrame, taken: DataFrame, family: int = FAMILY) -> DataFrame:
    """(key, id) of things (key, candidates): the first candidate, else the first with a counter from 2 on, that is neither
    taken (id) nor had by a thing of a lesser key.

    key: unique, of a type that orders; candidates: array of one or more strings. A null key, and no candidates, give no
    id. Equal to one after another in order of key.
    """
    spark = things.sparkSession
    asked = things.where(F.col("key").isNotNull() & (F.size("candidates") > 0)).select("key", "candidates", F.array_distinct(F.transform("candidates", _family)).alias("families"))
    asked = core.cut(spark, asked.withColumn("family", F.get("families", 0)))
    gone = taken.where("id is not null").select("id").distinct().withColumn("of", _family(F.col("id")))
    large = asked.groupBy("family").count().where(F.col("count") > family).select("family").union(asked.where("size(families) > 1").select(F.explode("families"))).distinct()
    large = core.cut(spark, large)
    small = asked.join(large, "family", "left_anti")
    out = small.groupBy("family").cogroup(gone.groupBy("of")).applyInArrow(_in_order, f"key {dict(things.dtypes)['key']}, id string")
    if large.isEmpty():
        return out
    return out.union(_in_rounds(asked.join(large, "family", "left_semi").select("key", "candidates"), gone.select("id")))


def _in_rounds(things: DataFrame, taken: DataFrame) -> DataFrame:
    """The same in rounds, until nobody has lost."""
    spark = things.sparkSession
    state = core.cut(spark, things.select("key", F.col("candidates").alias("names"), F.lit(1).alias("at"), F.lit(2).cast("long").alias("low")))
    gone = core.cut(spark, taken.withColumns({"stem": _stem(), "n": _number()}))
    held = None
    while True:
        early = state.where(F.col("at") <= F.size("names")).select("key", "names", "at", "low", F.element_at("names", F.col("at")).alias("id"))
        late = state.where(F.col("at") > F.size("names")).withColumn("stem", F.get("names", 0))
        proposed = early
        if held is None or not late.isEmpty():
            blocked = gone.where("stem <> ''").select("stem", "n")
            if held is not None:
                first = late.groupBy("stem").agg(F.min("key").alias("first"))
                blocked = blocked.union(held.where("not own and stem <> ''").join(first, "stem").where("key < first").select("stem", "n"))
            counted = _counters(late.select("key", "stem", "low"), blocked)
            proposed = early.unionByName(late.drop("low", "stem").join(counted, "key").select("key", "names", "at", F.col("n").alias("low"), F.concat_ws("-", "stem", F.col("n").cast("string")).alias("id")))
        proposed = core.cut(spark, proposed)
        best = proposed.groupBy("id").agg(F.min("key").alias("best")).join(gone.select("id"), "id", "left_anti")
        judged = core.cut(spark, proposed.join(best, "id", "left").withColumn("lost", ~F.coalesce(F.col("best") == F.col("key"), F.lit(False))))
        if judged.where("lost").isEmpty():
            return judged.select("key", "id")
        counter = F.col("at") > F.size("names")
        held = judged.where("not lost").select("key", _stem().alias("stem"), _number().alias("n"), (counter & (_stem() == F.get("names", 0))).alias("own"))
        state = judged.select("key", "names", F.when(F.col("lost") & ~counter, F.col("at") + 1).otherwise(F.col("at")).alias("at"), F.when(F.col("lost") & counter, F.col("low") + 1).otherwise(F.col("low")).alias("low"))


def stable_ids(clusters: DataFrame, mapped: DataFrame, registry: DataFrame, previous: DataFrame, preferred: str = "") -> DataFrame:
    """(key, id, others): the id of each cluster (key, ids array of "provider:id", candidates), and further ids that its
    provider ids were registered under.

    A mapped id (key, id) counts first, by the least provider id that has one; then ids registered (key, id) for its
    provider ids, of several that of the least provider id which starts with `preferred`, else the least; else one is
    allocated that no registered thing and none of `previous` (id) has.
    """
    keyed = clusters.select("key", F.explode("ids").alias("provided"))
    said = keyed.join(mapped.select(F.col("key").alias("provided"), F.col("id").alias("said")), "provided").groupBy("key").agg(F.min(F.struct("provided", "said"))["said"].alias("said"))
    known = keyed.join(registry.select(F.col("key").alias("provided"), F.col("id").alias("known")), "provided").groupBy("key").agg(F.array_sort(F.collect_set("known")).alias("known"), F.min(F.when(F.startswith("provided", F.lit(preferred)), F.struct("provided", "known")))["known"].alias("first"))
    found = clusters.select("key", "candidates").join(said, "key", "left").join(known, "key", "left").withColumn("id", F.coalesce("said", "first", F.get("known", 0)))
    found = core.cut(clusters.sparkSession, found)
    fresh = allocate(found.where("id is null").select("key", "candidates"), registry.select("id").union(previous.select("id")).union(mapped.select("id")))
    none = F.expr("cast(array() as array<string>)")
    old = found.where("id is not null").select("key", "id", F.array_except(F.coalesce("known", none), F.array("id")).alias("others"))
    return old.unionByName(fresh.select("key", "id", none.alias("others")))
