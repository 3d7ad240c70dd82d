"""Statements (item, property, value, label, rank, precision) as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pairs(statements: DataFrame) -> DataFrame:
    """Per item and property the values with labels, each value once (its first by ordinal), sorted by label; blank nodes are dropped."""
    kept = statements.where(F.col("value").isNotNull() & ~F.startswith(F.col("value"), F.lit("_:")))
    once = kept.groupBy("item", "property", "value").agg(F.min(F.struct("ordinal", "label"))["label"].alias("label"))
    return once.groupBy("item", "property").agg(F.array_sort(F.collect_list(F.struct("label", "value"))).alias("values"))


def pivoted(statements: DataFrame, properties: list[str]) -> DataFrame:
    """One row per item with a sorted array of values for each named property."""
    columns = [F.array_sort(F.collect_set(F.when(F.col("property") == p, F.col("value")))).alias(p) for p in properties]
    return statements.where(F.col("property").isin(*properties)).groupBy("item").agg(*columns)


def precision_date(time: Column, precision: Column) -> Column:
    """A partial date of a time by its precision: 9 year, 10 month, 11 day; null for coarser ones."""
    return F.when(precision == 9, F.regexp_extract(time, r"^\+?(\d{4})", 1)).when(precision == 10, F.regexp_extract(time, r"^\+?(\d{4}-\d{2})", 1)).when(precision >= 11, F.regexp_extract(time, r"^\+?(\d{4}-\d{2}-\d{2})", 1))


def earliest_dates(dates: DataFrame) -> DataFrame:
    """Of dates (item, time, precision, rank) each item's earliest that isn't deprecated, as a partial date."""
    kept = dates.where("rank <> 'deprecated'")
    return kept.groupBy("item").agg(F.min(F.struct("time", "precision")).alias("d")).select("item", precision_date(F.col("d.time"), F.col("d.precision")).alias("date"))


def labels(names: DataFrame, preferred: str = "en") -> DataFrame:
    """Of names (item, lang, label, alias) the preferred language's label, else the first by language, and all aliases."""
    other = F.col("lang") != preferred
    return names.groupBy("item").agg(F.min(F.when(F.col("label").isNotNull(), F.struct(other.alias("o"), "lang", "label")))["label"].alias("label"), F.array_sort(F.collect_set("alias")).alias("aliases"))


def discovered(developed: DataFrame, published: DataFrame, kinds: DataFrame, ids: DataFrame) -> DataFrame:
    """Union of two role tables (item, company), only items of the wanted kinds, with their smallest store id by number."""
    both = developed.withColumn("role", F.lit("developer")).unionByName(published.withColumn("role", F.lit("publisher")))
    least = ids.groupBy("item").agg(F.min(F.col("id").cast("long")).alias("store_id"))
    return both.join(kinds, "item", "left_semi").distinct().join(least, "item", "left")


def chosen_type(types: DataFrame, precedence: list[str]) -> DataFrame:
    """Of types (item, type) each item's first in the order of precedence; items with none of them are left out."""
    rank = F.array_position(F.array(*(F.lit(p) for p in precedence)), F.col("type"))
    return types.withColumn("n", rank).where("n > 0").groupBy("item").agg(F.min(F.struct("n", "type"))["type"].alias("type"))
