import random

import numpy as np
import pytest

from ferrule.llm import decontaminate as dc


def brute(text, items, window=13):
    words, hit, found = dc.words_of(text), set(), set()
    for name, item in items:
        own = dc.words_of(item)
        k = min(window, len(own))
        for j in range(len(own) - k + 1 if own else 0):
            for i in range(len(words) - k + 1):
                if words[i : i + k] == own[j : j + k]:
                    hit |= set(range(i, i + k))
                    found.add(name)
    return len(words), len(hit), sorted(found)


def some():
    rnd = random.Random(9)
    words = ["alpha", "Beta", "ÉCLAIR", "naïve", "x1", "the", "the", "of", "日本", "delta"]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    items = [(str(i), prose(rnd.choice([1, 3, 7, 12, 13, 14, 30]))) for i in range(25)] + [("e", ""), ("n", None)]
    texts = [prose(rnd.randrange(30)) + " - " + (rnd.choice(items)[1] or "") + "! " + prose(rnd.randrange(30)) for _ in range(80)]
    return [*texts, None, "", "the " * 400], items


@pytest.mark.parametrize("size", [10**9, 200])
def test_against_brute_force(spark, size):
    texts, items = some()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = dc.contamination(docs, spark.createDataFrame(items, "item_id string, text string"), block_bytes=size)
    rows = {r.doc_id: r.contamination for r in found.collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_hit, r["items"]) == brute(text, items) and r.n_hit == sum(s.end - s.start for s in r.spans)
        assert r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)


def test_winnowing_keeps_one_of_every_window():
    hashes = np.random.default_rng(1).integers(0, 50, 500).astype(np.uint64)
    kept = dc.winnow(hashes, 9)
    assert all(kept[i : i + 9].any() for i in range(len(hashes) - 8)) and kept.mean() < 0.6


def test_odd_rows(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "the same words again"), (1, "the same words again"), (None, "no id"), (3, None)], "item_id long, text string")
    out = dc.contamination(odd, bench, name="found")
    got = out.collect()
    assert out.columns == [*odd.columns, "found"] and len(got) == odd.count()
    assert [r.found["items"] for r in got if r.doc_id == 1] == [["1"]] and [r.found["items"] for r in got if r.doc_id is None] == [[""]]
    assert dc.contamination(nothing, bench).count() == 0 and dc.contamination(odd, bench.limit(0)).where("contamination.n_hit > 0").count() == 0
    with pytest.raises(ValueError):
        dc.contamination(odd.withColumn("Contamination", odd.doc_id), bench)


@pytest.mark.parametrize("size", [10**9, 30])
def test_columns_of_any_name_come_back(spark, odd, size):
    bench = spark.createDataFrame([(1, "the same words again"), (2, "no id")], "item_id long, text string")
    docs = odd.selectExpr("*", "777L as n_words", "true as contaminated", "struct(1 as `a b`) as s", "'k' as __row", "'w' as __words", "array(1) as items")
    got = dc.contamination(docs, bench, block_bytes=size)
    assert got.columns == [*docs.columns, "contamination"]
    assert sorted(map(str, got.drop("contamination").collect())) == sorted(map(str, docs.collect()))
