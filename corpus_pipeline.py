"""The corpus pipeline: five stages, each given what the one before kept; the documents go in, placed documents come out.

Rows are told apart by a key that each stage gives them for itself, never by doc_id, which may be null or repeated.
Helper columns take names that are free, so that a caller's columns of any name come through as they were. Every stage
gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm import decontaminate, mixing, sharding, simhash, toxicity
from ferrule.llm.common import forget, free_name, importable, saved


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs, written, with a row key under a free name."""
    key = free_name(docs.columns, "__row")
    return saved(docs.withColumn(key, F.monotonically_increasing_id()), "numbered"), key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the labels are those of the tables.

    Null, empty and wordless texts score like any text without evidence and stay; a text of any length is scored whole;
    repeated rows are judged alike.
    """
    name = free_name(docs.columns, "__toxicity")
    model = toxicity.model_of(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (Jaccard similarity of five-word shingles of 0.8 or more) one row: that with the
    smallest id, null ids last, of rows that share it any one.

    All texts without words, null ones among them, are one group; repeated rows are copies of each other; rows of
    unlike texts stay whatever their ids.
    """
    base, key = _numbered(docs)
    found = simhash.near_copies(base.select(F.col(key).alias("row"), "text"))
    found = found.join(base.select(F.col(key).alias("row"), "doc_id"), "row")
    keep = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")).select(F.col("first.row").alias(key))
    return base.join(keep, key).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark; null and empty texts have no words and stay."""
    name = free_name(docs.columns, "__contamination")
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name=name)
    return found.where(~F.col(f"{name}.contaminated")).drop(name)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; a null source is one of its own.

    Rows without words get copies like others, but a source whose rows are all without words has a target of zero and
    goes. Rows of equal id and size stand in the order of their texts' hashes, so that reruns agree.
    """
    base, key = _numbered(docs)
    sizes = base.select(F.xxhash64("text").alias("tie"), F.col(key).alias("number"), "doc_id", "source", mixing.word_count().alias("size"))
    taken = mixing.mixed(saved(sizes, "mix-sizes"), ties=("tie", "number")).where("copies > 0").select(F.col("number").alias(key), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(free_name(docs.columns, "__copy")))
    return base.join(taken, key).select(*docs.columns)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with all its columns, and its size, text_crc32, law, shard, slot and grown_shard; where a caller's column
    has such a name, it keeps it, and the new one gets underscores in front."""
    base, key = _numbered(docs)
    placed = sharding.sharded(base.select(F.col(key).alias("number"), "doc_id", "text"), ties=("number",))
    names, taken = {}, list(docs.columns)
    for c in ("size", "text_crc32", "law", "shard", "slot", "grown_shard"):
        names[c] = free_name(taken, c)
        taken.append(names[c])
    return base.join(placed.select(F.col("number").alias(key), *(F.col(c).alias(n) for c, n in names.items())), key).drop(key)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", place_in_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again, and deleted once the next has."""
    importable(spark)
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
        if last is not None:
            forget(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
