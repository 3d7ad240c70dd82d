"""Registration of queries: a function of (spark, sf_dir) and, where it can be said in SQL, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrule.session import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of a folder, read when named."""

    def __init__(self, spark: SparkSession, folder: str):
        importable(spark)
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def digest_sql(rows: str) -> str:
    """The same as content_digest() over a SELECT of lines."""
    sums = " || ':' || ".join(f"coalesce(sum(('0x' || substr(sha256(line), {at}, 15))::BIGINT), 0)::VARCHAR" for at in (1, 16, 31, 46))
    return f"SELECT count(*)::BIGINT AS records, coalesce(sum(strlen(line)), 0)::BIGINT AS bytes, sha256(count(*) || ':' || {sums}) AS sha256 FROM ({rows})"


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of Tables under a name."""

    def add(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return make

    return add
