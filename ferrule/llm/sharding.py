"""Sharding by sampled splitters, DataFrame functions only; the law is `bytes`: shard sizes near equal.

Records are ordered by (key, doc_id), where the key hashes the text, so that equal texts lie together. A sample of
the records, drawn with a chance in proportion to their size, gives quantile boundaries of many more ranges than
shards; records are range-partitioned by them. Within a range a running sum of sizes, on top of the exact sizes of
the ranges before it, tells where each record starts in the whole order, and thereby its shard and slot.

Equal texts stay in one shard: a group on a cut between two shards goes wholly to the side that has more of it, while
it holds at most GROUP of a shard's share. A larger group would make its range overfull, so that it is subdivided by
doc_id and spread over ranges. It may then lie across a cut, but only where it can't fit: a cut that moving by half of
GROUP takes to one of the group's ends is moved there. As the shards can't be smaller, at most shards / GROUP keys are
that large, which bounds the list of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.llm.common import saved, text_or_empty

SHARDS = 24
#: Part of a shard's share of bytes that a group of equal texts may hold without being spread over ranges; a cut moves by
#: up to half of it to keep a group whole.
GROUP = 0.05
#: Bytes of a range, about; at least RANGES and at most MOST_RANGES ranges; sampled records for each boundary.
RANGE_BYTES, RANGES, MOST_RANGES, OVERSAMPLE = 256_000_000, 96, 65_536, 16
#: Cells of the key space by which a record finds the boundaries near it.
CELL_BITS = 10


def text_key(text: Column) -> Column:
    """60 bits of the text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """(ties, doc_id, size, text_crc32, key) of every row; a null text counts no bytes and equals the empty text."""
    text = text_or_empty()
    return docs.select(*ties, "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_key(text).alias("key"))


def boundaries(units: DataFrame, total: int, ranges: int, oversample: int = OVERSAMPLE) -> DataFrame:
    """One row per cell of the key space: the number of boundaries before it and those inside, sorted.

    The sample is drawn by a hash of key, doc_id and size against the chance size / total * ranges * oversample, so
    that every run draws the same; larger records are always drawn.
    """
    chance = F.col("size") * (ranges * oversample / max(total, 1))
    drawn = units.where(F.pmod(F.xxhash64("key", "sub", "doc_id", "size"), F.lit(1 << 30)) < chance * (1 << 30)).select("key", "sub")
    ranked = drawn.withColumn("i", F.row_number().over(Window.orderBy("key", "sub"))).where(F.col("i") % oversample == 0).select("key", "sub").distinct()
    cells = ranked.groupBy(_cell(F.col("key")).alias("cell")).agg(F.array_sort(F.collect_list(F.struct("key", "sub"))).alias("inside"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    every = units.sparkSession.range(1 << CELL_BITS).select(F.col("id").alias("cell")).join(cells, "cell", "left")
    return every.select("cell", F.coalesce("inside", F.expr("cast(array() as array<struct<key:bigint,sub:bigint>>)")).alias("inside"), F.coalesce(F.sum(F.size(F.coalesce("inside", F.array()))).over(before), F.lit(0)).alias("skipped"))


def _cell(key: Column) -> Column:
    return F.shiftright(key, 60 - CELL_BITS)


def shard(records: DataFrame, shards: int = SHARDS, group: float = GROUP, ties: tuple[str, ...] = ()) -> DataFrame:
    """records (doc_id, size, text_crc32, key; materialised) with law, shard, slot and grown_shard (null for this law).

    ties: further columns of records (their names unlike the others'), which order rows of equal text and doc_id and are
    returned first. Repeated rows are
    records of their own. A null doc_id sorts first; ids may be of any type. A text of any length is one record; other
    columns are ignored. No rows give no rows.
    """
    total = records.agg(F.sum("size")).first()[0] or 0
    ranges = int(min(MOST_RANGES, max(RANGES, shards * 4, total // RANGE_BYTES)))
    number = F.col("doc_id").cast("long") if dict(records.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint") else F.xxhash64("doc_id")
    hot = records.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > total * group / shards).select("key", F.lit(True).alias("divided"))
    units = records.join(F.broadcast(hot), "key", "left").withColumn("sub", F.when(F.col("divided"), F.when(F.col("doc_id").isNull(), F.lit(-(1 << 62))).otherwise(number)).otherwise(F.lit(0)).cast("long"))
    where = units.withColumn("cell", _cell(F.col("key"))).join(F.broadcast(boundaries(units, total, ranges)), "cell")
    above = F.size(F.filter("inside", lambda x: (x["key"] < F.col("key")) | ((x["key"] == F.col("key")) & (x["sub"] <= F.col("sub")))))
    ranged = where.withColumn("range", (F.col("skipped") + above).cast("long")).drop("cell", "inside", "skipped")
    placed = saved(ranged, "shard-ranges")
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_at"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_at"))
    order = Window.partitionBy("range").orderBy("key", "sub", F.col("doc_id").asc_nulls_first(), "size", *ties)
    unit = Window.partitionBy("range", "key", "sub")
    run = placed.withColumn("behind", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("_nth", F.row_number().over(order))
    middle = F.when(F.col("divided"), F.col("behind") + F.col("size") / 2).otherwise(F.min("behind").over(unit) + F.sum("size").over(unit) / 2)
    run = run.withColumn("middle", middle).join(F.broadcast(starts), "range").withColumn("start", F.col("bytes_at") + F.col("behind"))
    run = saved(run.select(*ties, "doc_id", "size", "text_crc32", "key", "divided", "start", (F.col("bytes_at") + F.col("middle")).alias("middle"), (F.col("rows_at") + F.col("_nth") - 1).alias("at")), "shard-order")
    in_shards = lambda x: x * shards / max(total, 1)
    ends = run.where("divided").groupBy("key").agg(in_shards(F.min("start")).alias("head"), in_shards(F.max(F.col("start") + F.col("size"))).alias("tail"))
    ends = ends.select("key", F.when(F.ceil("head") - F.col("head") <= group / 2, F.ceil("head")).otherwise(F.floor("head")).alias("low"), F.when(F.col("tail") - F.floor("tail") <= group / 2, F.floor("tail") - 1).otherwise(F.floor("tail")).alias("high"))
    own = F.floor(in_shards(F.col("middle")))
    shard_of = F.least(F.greatest(F.when(F.col("low") <= F.col("high"), F.least(F.greatest(own, "low"), "high")).otherwise(own), F.lit(0)), F.lit(shards - 1)).cast("int")
    done = run.join(F.broadcast(ends), "key", "left").select(*ties, "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard_of.alias("shard"), "at")
    first = done.groupBy("shard").agg(F.min("at").alias("first"))
    return done.join(F.broadcast(first), "shard").select(*ties, "doc_id", "size", "text_crc32", "law", "shard", (F.col("at") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = SHARDS, ties: tuple[str, ...] = ()) -> DataFrame:
    return shard(saved(sized(docs, ties), "shard-sizes"), shards, ties=ties)


def query(spark, sf_dir: str) -> DataFrame:
    return sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE g AS (SELECT i AS n, i::BIGINT AS c, 0 AS k FROM range(256) AS t(i)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM g WHERE k < 8),
tab AS (SELECT list(c ORDER BY n) AS crcs FROM g WHERE k = 8),
r AS (SELECT doc_id, (strlen(coalesce(text, '')) + 8)::BIGINT AS size, coalesce(text, '') AS t,
  list_prepend(4294967295::BIGINT, CASE WHEN coalesce(text, '') = '' THEN [] ELSE
    list_transform(string_split_regex(rtrim(regexp_replace(hex(text), '(..)', '\1,', 'g'), ','), ','), lambda h: ('0x' || h)::BIGINT) END) AS bytes FROM documents),
k AS (SELECT *, ('0x' || substr(md5(t), 1, 15))::BIGINT AS key, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY t) AS held FROM r),
u AS (SELECT *, CASE WHEN held > total * 0.05 / 24 THEN doc_id ELSE 0 END AS sub FROM k),
o AS (SELECT *, sum(size) OVER (ORDER BY key, sub, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS behind,
        row_number() OVER (ORDER BY key, sub, doc_id, size) - 1 AS pos FROM u),
m AS (SELECT *, (min(behind) OVER (PARTITION BY key, sub) + sum(size) OVER (PARTITION BY key, sub) / 2.0) * 24 / total AS middle,
        min(behind) OVER (PARTITION BY key) * 24.0 / total AS head, max(behind + size) OVER (PARTITION BY key) * 24.0 / total AS tail FROM o),
f AS (SELECT *, CASE WHEN ceil(head) - head <= 0.025 THEN ceil(head) ELSE floor(head) END AS low, CASE WHEN tail - floor(tail) <= 0.025 THEN floor(tail) - 1 ELSE floor(tail) END AS high FROM m),
s AS (SELECT *, least(CASE WHEN held > total * 0.05 / 24 AND low <= high THEN least(greatest(floor(middle), low), high) ELSE floor(middle) END, 23)::INT AS shard FROM f)
SELECT doc_id, size, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, crcs[(xor(a, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (pos - min(pos) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard FROM s, tab
"""
