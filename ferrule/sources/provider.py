"""A provider on files as a Spark data source: records that are asked for by external ids.

The fixture of a provider is a folder of JSON lines, `bucket=<n>/<file>`, with one line {"id", "ids", "record"} for each id
that a record has. Each file is a partition of the scan. Filters on `bucket` are taken over by the source, so that a
question about few ids opens few files.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

NAME, BUCKETS = "ferrule_fixture", 64
SHAPE = "bucket int, id string, ids array<string>, record string"
ARROW = pa.schema([("bucket", pa.int32()), ("id", pa.string()), ("ids", pa.list_(pa.string())), ("record", pa.string())])
LINES = 10_000


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


class File(InputPartition):
    """One file of a bucket."""

    def __init__(self, path: str, bucket: int):
        self.path, self.bucket = path, bucket


class FixtureReader(DataSourceReader):
    """Lists the files of the buckets that are asked for and reads their lines."""

    def __init__(self, path: str):
        self.path, self.wanted = path, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("bucket",):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, top = _opened(self.path)
        found = []
        for info in system.get_file_info(fs.FileSelector(top, recursive=True)):
            folder = os.path.basename(os.path.dirname(info.path))
            if info.type != fs.FileType.File or info.base_name.startswith(("_", ".")) or not folder.startswith("bucket="):
                continue
            bucket = int(folder[len("bucket=") :])
            if self.wanted is None or bucket in self.wanted:
                found.append(File(info.path, bucket))
        return found or [File("", -1)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = _opened(self.path)
        rows: list[dict] = []
        with system.open_input_stream(partition.path) as raw:
            for number, line in enumerate(_lines(raw), 1):
                try:
                    x = json.loads(line)
                    rows.append({"bucket": partition.bucket, "id": x["id"], "ids": x["ids"], "record": x["record"]})
                except (ValueError, KeyError, TypeError) as error:
                    raise ValueError(f"{partition.path}:{number}: not a record: {error}") from error
                if len(rows) == LINES:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


def _lines(raw: pa.NativeFile) -> Iterator[bytes]:
    """The lines of a stream, read in blocks."""
    rest = b""
    while block := raw.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from (line for line in whole if line.strip())
    if rest.strip():
        yield rest


class FixtureSource(DataSource):
    """`spark.read.format("ferrule_fixture").load(folder)`: (bucket, id, ids, record)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SHAPE

    def reader(self, schema) -> FixtureReader:
        return FixtureReader(self.options["path"])


def bucket_of(id: F.Column) -> F.Column:
    return F.pmod(F.crc32(id), F.lit(BUCKETS)).cast("int")


def write_fixture(records: DataFrame, path: str) -> None:
    """Writes (ids array<string>, record string) as a fixture. Null ids are left out; a record without ids can't be asked for."""
    ids = F.array_distinct(F.array_compact("ids"))
    rows = records.select(F.explode(ids).alias("id"), ids.alias("ids"), F.coalesce("record", F.lit("")).alias("record")).withColumn("bucket", bucket_of(F.col("id")))
    spread = rows.repartition("bucket", F.pmod(F.xxhash64("record"), F.lit(4)))  # a hot id's records lie in four files
    spread.write.partitionBy("bucket").option("ignoreNullFields", False).json(path)


def fetch_fixture(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """(ids, record) of every record that has one of the ids asked for; each pair once. A missing folder or a bad line fails."""
    spark.dataSource.register(FixtureSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    buckets = [r.bucket for r in asked.select(bucket_of(F.col("id")).alias("bucket")).distinct().collect()]  # at most BUCKETS
    rows = spark.read.format(NAME).load(path).where(F.col("bucket").isin(*buckets) if buckets else F.lit(False))
    return rows.join(asked.select("id").distinct(), "id", "left_semi").select("ids", "record").distinct()
