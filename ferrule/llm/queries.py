"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrule.llm import alignment, ctw, decontaminate, gif, hardnegatives, linededup, mixing, pii, sharding, simhash, suffixdedup, toxicity, warc
from ferrule.llm.common import importable


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


_ALL = {
    "op1_gif": gif.query,
    "op2_ctw": ctw.query,
    "op3_toxicity": toxicity.query,
    "op4_suffix_dedup": suffixdedup.query,
    "op5_sharding": sharding.query,
    "op6_warc": warc.query,
    "op7_mixing": mixing.query,
    "op8_line_dedup": linededup.query,
    "op9_simhash": simhash.query,
    "op10_decontaminate": decontaminate.query,
    "op11_pii": pii.query,
    "op12_hard_negatives": hardnegatives.query,
    "op13_alignment": alignment.query,
}

QUERIES = {name: _ready(query) for name, query in _ALL.items()}

ORACLE: dict[str, str] = {
    "op5_sharding": sharding.SQL,
    "op6_warc": warc.SQL,
    "op7_mixing": mixing.SQL,
    "op8_line_dedup": linededup.SQL,
    "op10_decontaminate": decontaminate.SQL,
    "op12_hard_negatives": hardnegatives.SQL,
}
