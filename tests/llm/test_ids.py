"""Ids and other nullable numbers stay what they are, in every operator and registered query."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ferrule.llm import ctw, decontaminate, gif, linededup, mixing, queries, sharding, simhash, suffixdedup, toxicity
from ferrule.llm.common import free_name

BIG = [None, 2**53 + 1, 2**53 + 3, 0, 200, 199]
TEXT = "this text is long enough to have some shingles and bytes of its own, number {0} of them; " * 3


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, TEXT.format(n), "en", "s", None if n % 2 else 2**53 + n) for n, i in enumerate(BIG)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


def key(v):
    return (v is None, v or 0)


@pytest.mark.parametrize("run", [
    lambda d: gif.stored(d),
    lambda d: ctw.scored(d.selectExpr("*", "doc_id > 5 as held_out")),
    lambda d: toxicity.scored(d, toxicity.fit([])),
    lambda d: suffixdedup.deduplicated(d),
    lambda d: sharding.sharded(d),
    lambda d: mixing.mix(d),
    lambda d: linededup.deduplicated(d),
    lambda d: simhash.near_duplicates(d),
    lambda d: decontaminate.contamination(d, d.selectExpr("1 as item_id", "text").limit(1)),
], ids="gif ctw toxicity suffixdedup sharding mixing linededup simhash decontaminate".split())
def test_ids_survive(docs, run):
    out = run(docs)
    got = out.collect()
    assert sorted((r.doc_id for r in got), key=key) == sorted(BIG, key=key)
    if "n_chars" in out.columns:
        assert sorted(((r.doc_id, r.n_chars) for r in got), key=lambda x: key(x[0])) == sorted(((r.doc_id, r.n_chars) for r in docs.collect()), key=lambda x: key(x[0]))


@pytest.mark.parametrize("run", [gif.stored, simhash.near_duplicates, sharding.sharded, mixing.mix, suffixdedup.deduplicated, linededup.deduplicated, lambda d: ctw.scored(d.selectExpr("*", "false as held_out"))])
def test_ids_of_text(spark, run):
    docs = spark.createDataFrame([("b7", "one two three", "s"), (None, "four five", "s"), ("a", None, None)], "doc_id string, text string, source string")
    assert {r.doc_id for r in run(docs).collect()} == {"b7", None, "a"}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("ids")
    texts = [TEXT.format(n) for n in range(len(BIG))]
    pq.write_table(pa.table({"doc_id": pa.array(BIG, pa.int64()), "text": texts, "lang": ["en"] * len(BIG), "source": ["s"] * len(BIG), "n_chars": pa.array([None] * len(BIG), pa.int64())}), at / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([0, 200], pa.int64()), "quality": pa.array([0, 1], pa.int32()), "toxic": pa.array([0, 1], pa.int32())}), at / "labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1], pa.int64()), "text": [texts[0]]}), at / "benchmark.parquet")
    pq.write_table(pa.table({"page_id": pa.array(BIG, pa.int64()), "url": ["u"] * len(BIG), "html": texts}), at / "pages.parquet")
    return str(at)


# op12 has no documents; its ids are in test_hardnegatives.py
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op12_hard_negatives"}))
def test_registered_queries(spark, folder, name):
    got = queries.QUERIES[name](spark, folder).collect()
    column = "page_id" if name.startswith("op6") else "doc_id"
    assert sorted((r[column] for r in got), key=key) == sorted(BIG, key=key)


def test_free_names():
    assert free_name(["A", "_a", "b"], "a") == "__a" and free_name([], "a") == "a"
