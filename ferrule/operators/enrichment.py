"""Enrichment: providers are asked in rounds for every id that is known, until no answer brings a new one."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.operators.core import shared_folder

RECORDS, STATUS = "provider string, ids array<string>, record string, state string", "provider string, status string, detail string"
#: Asks a provider: (id) in, (ids array<string>, record string) out; lazy or not, it may fail.
Fetch = Callable[[DataFrame], DataFrame]


def enrich(spark: SparkSession, seeds: DataFrame, providers: Mapping[str, Fetch], previous: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(provider, ids, record, state) and (provider, status, detail).

    seeds: (id); null ids are left out. A round asks each provider for the ids that it wasn't asked for yet; ids of its
    records are asked for in the next round, everywhere. A provider that fails doesn't stop the others: its ids stay open
    and are asked for again with the next round, its status is `error` with the message, and of its records in `previous`
    (provider, ids, record) those whose ids weren't fetched are carried over (state `carried`). Of records of one
    provider with the same set of ids the last round's counts, in a round the greatest. It ends when a round brings no
    id that is new, whatever the number of rounds; without seeds or providers nothing is asked.
    """
    folder = shared_folder(spark)
    shape = "provider string, ids array<string>, record string, round int"

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    fresh = written(seeds.where("id is not null").select(F.col("id").cast("string").alias("id")).distinct(), "known-0")
    known, answers, failed = fresh, spark.createDataFrame([], shape), {}
    open_ = dict.fromkeys(providers, fresh)  # what a provider is still to be asked for
    number = 0
    while not fresh.isEmpty():
        number += 1
        found = spark.createDataFrame([], shape)
        for at, (name, fetch) in enumerate(providers.items()):
            try:
                ids = F.array_sort(F.array_distinct(F.array_compact("ids")))
                got = written(fetch(open_[name]).select(F.lit(name).alias("provider"), ids.alias("ids"), "record", F.lit(number).alias("round")), f"records-{number}-{at}")
            except Exception as error:  # noqa: BLE001  whatever a provider dies of, the others go on
                failed[name] = str(error).strip().splitlines()[0] if str(error).strip() else type(error).__name__
                continue
            open_[name] = None
            found = found.unionByName(got)
        answers = answers.unionByName(found)
        fresh = written(found.select(F.explode("ids").alias("id")).distinct().join(known, "id", "left_anti"), f"known-{number}")
        known = known.unionByName(fresh)
        open_ = {name: fresh if ids is None else ids.unionByName(fresh) for name, ids in open_.items()}
    last = answers.groupBy("provider", "ids").agg(F.max(F.struct("round", "record")).alias("m")).select("provider", "ids", F.col("m.record").alias("record"), F.lit("fetched").alias("state"))
    if previous is not None and failed:
        old = previous.where(F.col("provider").isin(*failed)).select("provider", F.array_sort(F.array_distinct(F.array_compact("ids"))).alias("ids"), "record")
        gone = old.join(last.select("provider", "ids"), ["provider", "ids"], "left_anti").groupBy("provider", "ids").agg(F.max("record").alias("record"))
        last = last.unionByName(gone.withColumn("state", F.lit("carried")))
    status = spark.createDataFrame([(n, "error" if n in failed else "ok", failed.get(n)) for n in providers], STATUS)
    return last, status
