"""Reading and writing of documents: text, JSON, YAML-like seeds, cached responses, published folders."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): whole files without a byte-order mark."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.regexp_replace("value", "^﻿", "").alias("text"))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, missing_ok: bool = False) -> DataFrame:
    """Whole-document JSON by a declared schema; a malformed document fails. A missing path is empty if missing_ok."""
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A layer that an earlier stage may not have written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def seeds(spark: SparkSession, rows: Iterable[dict], schema: str, defaults: dict[str, object]) -> DataFrame:
    """Curated rows, few enough to be kept in files by hand; unknown fields are refused, absent ones get defaults."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    made = []
    for i, row in enumerate(rows):
        if unknown := set(row) - set(kind.names):
            raise ValueError(f"row {i}: unknown fields {sorted(unknown)}")
        made.append(tuple(row.get(n, defaults.get(n)) for n in kind.names))
    return spark.createDataFrame(made, kind)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def request_key(method: str, url: str, body: str = "") -> F.Column:
    return F.sha2(F.concat_ws("\n", F.lit(method), F.lit(url), F.lit(body)), 256)


def cached_responses(raw: DataFrame, now: str, ttl_days: float, offline: bool = False) -> DataFrame:
    """Of raw (key, fetched_at, status, body) each key's newest response that still holds; errors hold as null bodies.

    Offline any age holds.
    """
    newest = raw.groupBy("key").agg(F.max(F.struct("fetched_at", "status", "body")).alias("r")).select("key", "r.*")
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("fetched_at").cast("timestamp"))) / 86_400e6
    return newest.where(F.lit(offline) | (age <= ttl_days)).select("key", "status", F.when(F.col("status") < 400, F.col("body")).alias("body"))


def json_schema(schema: T.StructType, title: str) -> str:
    """A JSON Schema document of a table."""
    names = {"string": "string", "integer": "integer", "long": "integer", "double": "number", "boolean": "boolean", "date": "string", "timestamp": "string", "timestamp_ntz": "string"}

    def kind(t: T.DataType) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "properties": {f.name: kind(f.dataType) for f in t.fields}, "required": [f.name for f in t.fields if not f.nullable], "additionalProperties": False}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": kind(t.elementType)}
        if isinstance(t, T.MapType):
            return {"type": "object", "additionalProperties": kind(t.valueType)}
        return {"type": names.get(t.typeName(), "string")}

    return json.dumps({"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title, "type": "array", "items": kind(schema)}, indent=2, sort_keys=True)


def publish(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None) -> str:
    """Writes a table sorted within its files, unless the folder has the same content; the content's hash.

    The hash is a sum over rows, so that it needs no order and no row leaves its executor.
    """
    spark = df.sparkSession
    row = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    digest = lambda d: "{}:{}".format(*d.agg(F.count("*"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0))).first())
    now = digest(df)
    try:
        if digest(spark.read.schema(df.schema).parquet(path)) == now:
            return now
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    writer = df.sortWithinPartitions(*keys).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return now


def snapshot(df: DataFrame, path: str, label: str) -> None:
    """An immutable copy under a label; a second one of the same label fails."""
    df.write.mode("errorifexists").parquet(f"{path}/label={label}")
