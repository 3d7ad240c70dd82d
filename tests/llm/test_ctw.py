import math
import os

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import ctw


def brute_tree(texts, depth=ctw.DEPTH):
    """Counts of zeros and ones by (bits so far, context), for every depth."""
    counts = {}
    for text in texts:
        padded = ctw.END * depth + text
        for i in range(depth, len(padded)):
            byte, context, prefix = padded[i], padded[i - depth : i][::-1], 1
            for j in range(8):
                bit = byte >> (7 - j) & 1
                for d in range(depth + 1):
                    counts.setdefault((prefix, context[:d]), [0, 0])[bit] += 1
                prefix = prefix << 1 | bit
    return counts


def brute_log10(texts, queries, depth=ctw.DEPTH):
    counts = brute_tree(texts, depth)
    below = {}
    for p, c in counts:
        if c:
            below.setdefault((p, c[:-1]), []).append((p, c))

    def kt(node):
        a, b = counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def weighted(node):
        if node not in memo:
            own = kt(node)
            memo[node] = own if len(node[1]) == depth else np.logaddexp(math.log(0.5) + own, math.log(0.5) + sum(weighted(x) for x in below[node]))
        return memo[node]

    def chance(prefix, context):
        value = None
        for d in range(depth, -1, -1):
            node = (prefix, context[:d])
            if node not in counts:
                continue
            a, b = counts[node]
            own = (b + 0.5) / (a + b + 1)
            if value is None:
                value = own
            else:
                beta = math.exp(math.log(0.5) + kt(node) - weighted(node))
                value = beta * own + (1 - beta) * value
        return 0.5 if value is None else value

    out = []
    for text in queries:
        padded, total = ctw.END * depth + text, 0.0
        for i in range(depth, len(padded)):
            prefix = 1
            for j in range(8):
                bit = padded[i] >> (7 - j) & 1
                p = chance(prefix, padded[i - depth : i][::-1])
                total += math.log10(p if bit else 1 - p)
                prefix = prefix << 1 | bit
        out.append(total)
    return out


TRAIN = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "Ünïcode the mat", ""]
HELD = ["the cat and the dog", "zebra", "", None]


def frame():
    return pd.DataFrame({"doc_id": range(len(TRAIN) + len(HELD)), "text": TRAIN + HELD, "held_out": [False] * len(TRAIN) + [True] * len(HELD)})


def test_against_brute_force(spark):
    got = {r.doc_id: r for r in ctw.scored(spark.createDataFrame(frame().astype({"text": object})), chunk_bytes=40).collect()}
    bytes_of = [b" ".join(ctw.tokens(t)) + ctw.END for t in TRAIN + HELD]
    want = brute_log10(bytes_of[: len(TRAIN)], bytes_of)
    assert [got[i].score for i in range(len(want))] == pytest.approx(want, rel=1e-5)
    words = [w for t in TRAIN for w in [*ctw.tokens(t), ctw.END]]
    n, v = len(words), len(set(words))
    for i, t in enumerate(TRAIN + HELD):
        own = [*ctw.tokens(t), ctw.END]
        assert got[i].train_tokens == n and got[i].n_tokens == len(own) and got[i].n_known == sum(w in words for w in own)
        assert got[i].base_score == pytest.approx(sum(math.log10((words.count(w) + 0.1) / (n + 0.1 * (v + 1))) for w in own))


def test_bits_are_a_distribution():
    chunk = ctw.Chunk(TRAIN, np.zeros(len(TRAIN), bool))
    context = b"e mat"
    probe = [context + bytes((b,)) for b in range(256)]
    keys = np.array(sorted(int.from_bytes(p, "big") for p in probe), np.uint64)
    own, n = chunk.strings()
    every, counts = ctw.summed(np.concatenate((own, keys)), np.concatenate((n, np.zeros(256, np.int64))))
    nodes = ctw.Nodes(every, counts)
    near = ctw.completed(nodes.top())
    top = near.assign(prefix=near["node"].to_numpy() >> 16, near=(near["node"].to_numpy() >> 8) & 0xFF).groupby(["prefix", "near"], as_index=False)[["zeros", "ones", "weighted"]].sum()
    logs = nodes.log10(near, ctw.above(top))[np.searchsorted(every, keys)]
    assert (10**logs).sum() == pytest.approx(1)


def test_counts_are_added_up_chunk_by_chunk(monkeypatch):
    rng = np.random.default_rng(1)
    frame, whole = [], {}
    for _ in range(20):
        keys = np.unique(rng.integers(0, 500, 60).astype(np.uint64))
        counts = rng.integers(0, 9, len(keys))
        for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
            whole[k] = whole.get(k, 0) + c
        frame.append({"keys": ctw.packed(np.diff(keys, prepend=np.uint64(0))), "counts": ctw.packed(counts)})
    for most in (50, 10**9):
        monkeypatch.setattr(ctw, "MERGE_KEYS", most)
        keys, counts = ctw._merged(pd.DataFrame(frame))
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == dict(sorted(whole.items()))


def test_many_buckets_and_chunks(spark, monkeypatch):
    """However the strings are dealt, the scores are the same."""
    docs = spark.createDataFrame(frame().astype({"text": object})).repartition(3)
    want = {r.doc_id: r.score for r in ctw.scored(docs).collect()}
    monkeypatch.setattr(ctw, "LEAST_BUCKETS", 40)
    got = {r.doc_id: r.score for r in ctw.scored(docs, chunk_bytes=5).collect()}
    assert got == pytest.approx(want, rel=1e-5)


def test_a_bucket_gets_no_large_share(spark):
    """No bucket of 512 has more than a hundredth of the distinct strings of a real text."""
    folder = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(folder):
        pytest.skip("no tables")
    texts = [r.text for r in spark.read.parquet(folder).select("text").collect()]
    keys, _ = ctw.Chunk(texts, np.zeros(len(texts), bool)).strings()
    assert np.bincount(ctw.string_bucket(keys, 512)).max() < 0.01 * len(keys)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(0.5, 1e7), min_size=1, max_size=20))
def test_log_gamma(x):
    assert ctw.log_gamma(np.array(x)) == pytest.approx([math.lgamma(v) for v in x], rel=1e-10, abs=1e-9)


def test_odd_rows(spark, odd, nothing):
    from pyspark.sql import functions as F

    got = ctw.scored(odd.withColumn("held_out", F.lit(True))).collect()
    assert len(got) == odd.count() and all(r.n_known == 0 and r.score < 0 and r.train_tokens == 0 for r in got)
    assert ctw.scored(nothing.withColumn("held_out", F.lit(False))).count() == 0
