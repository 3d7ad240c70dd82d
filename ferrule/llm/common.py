"""What the operators of this subpackage share: shared storage, text columns, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ferrule.session import importable

__all__ = ["SPACE", "components", "discard", "forget", "free_name", "id_crc", "importable", "new_path", "saved", "shared_folder", "text_or_empty", "total_bytes", "with_values"]

SPACE = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session (tests) gets
    one of its own; on a cluster that is an error, as no folder of one machine would do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ferrule-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/ferrule-{uuid.uuid4().hex}/{name}"


def saved(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """df written as Parquet in the shared folder and read back: cuts the lineage and survives lost executors.

    free: the driver collects its garbage afterwards, as Spark deletes shuffle files on disk and broadcast tables in the
    executors' memory once nothing refers to them.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if free:
        df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that new_path() named."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget(df: DataFrame) -> None:
    """Delete the files of a table that saved() wrote, once nothing will read it again."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        discard(df.sparkSession, path)


def free_name(taken: Iterable[str], name: str) -> str:
    """name, or name with underscores in front until no taken name equals it without regard to case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def with_values(df: DataFrame, fields: str, values: Callable[[list], Iterable[tuple]], column: str = "text", rows: int = 500) -> DataFrame:
    """df with further columns (fields, as DDL), which values() makes of the given column, `rows` at a time.

    The rows pass through as Arrow batches and no column of df is converted: ids and other nullable numbers stay what
    they are. The new names must be free in df.
    """
    added = StructType.fromDDL(fields)
    kinds = [to_arrow_type(f.dataType) for f in added.fields]
    place = [c.lower() for c in df.columns].index(column.lower())
    names = [*df.columns, *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                new = list(zip(*values(part.column(place).to_pylist()), strict=True))
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, k) for c, k in zip(new, kinds, strict=True))], names=names)

    return df.mapInArrow(run, StructType([*df.schema.fields, *added.fields]))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id as text, unsigned; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def total_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node reachable.

    Alternates large-star and small-star steps: each joins every node's neighbours to the smallest of them, so
    that every component becomes a star around its smallest node in a logarithmic number of rounds. The edge list
    never grows. Each round is written to shared storage. Self-loops are allowed, nulls are not.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(least, "a")
        if large:
            moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-edges")
    seen = None
    for _ in range(rounds):
        before, now = now, saved(star(star(now, True), False), f"{name}-round", free=True)
        forget(before)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not converge")
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
