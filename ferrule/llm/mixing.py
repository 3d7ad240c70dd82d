"""Mixing sources to target weights by systematic sampling.

Each source's target fixes the copies that one of its documents is expected to get (target / source size). Within
a source the documents stand in the order of their size; the running sum of expected copies, shifted by one random
offset, crosses an integer as often as a document is emitted. As every document of a source expects equally many
copies, the running sum before a document is its rank times that number.

Ranks are distributed: documents are counted by cell (source, size class, strand), where the strands cut a class into
pieces of bounded size; only cell counts meet in windows, and a row number runs within a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.llm.common import SPACE, saved

#: Fixed values of the contract.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
SEED = "mix-1"
#: Documents of one size class and source that one strand holds, about.
STRAND_ROWS = 2_000
#: Steps of the size classes in each doubling of the size.
STEPS = 16


def word_count(name: str = "text") -> Column:
    """Number of words of a text; null counts none."""
    return F.coalesce(F.regexp_count(F.col(name), F.lit(SPACE)).cast("long"), F.lit(0).cast("long"))


def size_class(size: Column) -> Column:
    """Ordered like the size: whole powers of two, each cut into STEPS equal steps; one class for zero."""
    doubling = F.length(F.bin(size)) - 1
    step = F.floor((size / F.pow(F.lit(2.0), doubling) - 1) * STEPS)
    return F.when(size <= 0, F.lit(-1).cast("long")).otherwise((doubling * STEPS + step).cast("long"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) for every source of sizes (source, source_size).

    The weights repeat over the sources by code point, null last. Together the targets are `share` of all sizes; no
    target exceeds `most` times its source's size, and what lies above is shared again by weight until none does.
    That is a water level: with the sources by most * size / weight, the first ones are full and the others get the
    level times their weight. One row per source, so the windows over all of them stay small.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("bound", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("pool", F.lit(float(share)) * F.sum("source_size").over(everything)).withColumn("full", F.coalesce(F.sum("bound").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", (F.col("pool") - F.col("full")) / F.col("open")).withColumn("is_full", F.col("bound") / F.col("weight") <= F.col("level"))
    level = F.min(F.when(~F.col("is_full"), F.struct((F.col("bound") / F.col("weight")).alias("ratio"), "source", "level"))).over(everything)["level"]
    return rows.withColumn("target", F.when(F.col("is_full"), F.col("bound")).otherwise(level * F.col("weight"))).select("source", "source_size", F.col("target").cast("double"))


def offset(source: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) for a source, the same at every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def strand_of(strands: Column) -> Column:
    """A document's strand, by 48 bits of the MD5 of its id and size: ids with a common divisor spread all the same."""
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(named.cast("binary")), 1, 12), 16, 10).cast("long"), strands)


def mixed(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED, strand_rows: int = STRAND_ROWS, ties: tuple[str, ...] = ()) -> DataFrame:
    """sized (doc_id, source, size) with source_size, target, copies (int) and taken (copies times size).

    ties: further columns of sized, which order rows of equal doc_id and size and are returned first.

    A null source is a source of its own; documents of size zero get copies like any other and take nothing; a source
    of size zero has target zero and no copies; repeated rows count as documents of their own, and null ids and ids of
    any type do; a text of any length counts whole; other columns are ignored. An empty table gives an empty result. No
    copies exceed `most` rounded up.
    """
    rows = sized.select(*ties, "doc_id", "source", "size").withColumn("class", size_class(F.col("size")))
    n_rows = rows.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    classes = saved(n_rows, "mix-classes")
    total = targets(classes.groupBy("source").agg(F.sum("s").alias("source_size")), weights, share, most)
    in_source = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    strands = F.ceil(F.col("n") / strand_rows).cast("long")
    first = classes.withColumn("class_at", F.coalesce(F.sum("n").over(in_source), F.lit(0))).withColumn("strands", strands)
    first = first.select(F.col("source").alias("c_source"), F.col("class").alias("c_class"), "class_at", "strands")
    total = total.select(F.col("source").alias("t_source"), "source_size", "target")
    frame = first.join(total, F.col("c_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    placed = rows.join(frame, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class"))).drop("c_source", "c_class")
    placed = placed.withColumn("strand", strand_of(F.col("strands")))
    cells = placed.groupBy("source", "class", "strand").agg(F.count("*").alias("n"))
    in_class = Window.partitionBy("source", "class").orderBy("strand").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_at", F.coalesce(F.sum("n").over(in_class), F.lit(0))).select(F.col("source").alias("c_source"), F.col("class").alias("c_class"), F.col("strand").alias("c_strand"), "cell_at")
    out = placed.join(cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class")) & (F.col("strand") == F.col("c_strand")))
    in_cell = Window.partitionBy("source", "class", "strand").orderBy("doc_id", "size", *ties)
    rank = F.col("class_at") + F.col("cell_at") + F.row_number().over(in_cell) - 1
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    out = out.withColumn("rank", rank).withColumn("each", each).withColumn("at", offset(F.col("source"), seed))
    copies = F.floor((F.col("rank") + 1) * F.col("each") + F.col("at")) - F.floor(F.col("rank") * F.col("each") + F.col("at"))
    return out.withColumn("copies", copies.cast("int")).select(*ties, "doc_id", "source", "size", F.col("source_size").cast("long"), "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """mixed() of a table of documents; size is the number of words."""
    return mixed(saved(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes"))


def query(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS source_size, 2.0 * sum(size) AS bound,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
      FROM d GROUP BY source),
w AS (SELECT *, bound / weight AS ratio, 1.5 * sum(source_size) OVER () AS pool,
        coalesce(sum(bound) OVER b, 0.0) AS filled, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0) AS rest
      FROM s WINDOW b AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (pool - filled) / rest AS level FROM w),
tg AS (SELECT source, CASE WHEN ratio <= level THEN bound
         ELSE (SELECT arg_min(level, filled) FROM l AS m WHERE m.ratio > m.level) * weight END AS target FROM l),
r AS (
  SELECT *, CASE WHEN size <= 0 THEN -1 ELSE k * 16 + ((size - (1::BIGINT << k)) * 16) // (1::BIGINT << k) END AS class
  FROM (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) - 1 ELSE 0 END AS k FROM d)),
c AS (SELECT *, ceil(count(*) OVER (PARTITION BY source, class) / 2000.0)::BIGINT AS strands FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || size::VARCHAR), 1, 12))::BIGINT % strands, doc_id, size) - 1 AS rank,
        (('0x' || substr(md5('mix-1:' || coalesce('s' || source, 'n')), 1, 12))::BIGINT)::DOUBLE / 281474976710656.0 AS shift FROM c)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, copies::INT AS copies, (copies * size)::BIGINT AS taken
FROM (SELECT o.*, s.source_size, tg.target,
        floor((rank + 1) * (CASE WHEN s.source_size > 0 THEN target / s.source_size ELSE 0 END) + shift) - floor(rank * (CASE WHEN s.source_size > 0 THEN target / s.source_size ELSE 0 END) + shift) AS copies
      FROM o JOIN s ON o.source IS NOT DISTINCT FROM s.source JOIN tg ON o.source IS NOT DISTINCT FROM tg.source)
"""
