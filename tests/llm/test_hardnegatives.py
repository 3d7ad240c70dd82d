"""Vantage-point search against brute force."""

import numpy as np
import pytest

from ferrule.llm import hardnegatives as hn

KINDS = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, every=100):
    part = [(i, np.floor(np.array(v, np.float64) * 256).astype(np.int64), c) for i, v, c in rows if c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in part), default=0)
    part = [(i, np.concatenate([v, np.zeros(width - len(v), np.int64)]), c) for i, v, c in part]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for n, (a, v, c) in enumerate(part):
        if a is None or a % every:
            continue
        scored = [(int(v @ w), i, d) for m, (i, w, d) in enumerate(part) if m != n]
        for ps, p, _ in sorted((x for x in scored if x[2] == c), key=order)[:5]:
            fits = sorted((x for x in scored if x[2] != c and 30 * ps <= 100 * x[0] <= 90 * ps), key=order)[:10]
            out += [(a, p, r + 1, i, ps, s) for r, (s, i, _) in enumerate(fits)]
    return out


def made(n, dims, labels, seed, copies=0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        c = int(rng.integers(labels))
        rows.append((i, (middle[int(rng.integers(labels))] * 0.3 + rng.normal(size=dims) * 0.2).astype(np.float32).tolist(), c))
    return rows + [(n + i, rows[0][1], i % labels) for i in range(copies)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], KINDS)


key = lambda r: tuple((x is None, x or 0) for x in r)


def same(spark, rows, every=100):
    got = [tuple(r) for r in hn.mined(frame(spark, rows), every).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, every), key=key)
    return got


@pytest.mark.parametrize("shape", [(400, 8, 3, 1, 0), (300, 2, 2, 2, 300), (150, 16, 10, 3, 0)])
def test_equals_brute_force(spark, monkeypatch, shape):
    """Many leaves, pieces and buckets, and a vector that half of all rows share."""
    monkeypatch.setattr(hn, "BUCKET_ROWS", 8)
    monkeypatch.setattr(hn, "ASK_BLOCK", 7)
    build = hn.build
    monkeypatch.setattr(hn, "build", lambda base: build(base, piece_rows=50, leaves=8))
    assert same(spark, made(*shape), every=20)


def test_odd_rows(spark):
    """Nulls, non-finite and missing components, ties, repeated and null ids, vectors of other lengths, negative scores."""
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (2, [0.5, 0.0], 2), (None, [0.5, 0.0], 2), (3, None, 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 2),
        (6, [float("inf"), 1.0], 2), (7, [0.6, 0.1], None), (8, [0.6], 3), (9, [], 3), (100, [-1.0, 0.5], 4), (101, [1.0, -0.5], 4), (-100, [0.4, 0.0, 2.0], 5), (-100, [0.4, 0.0, 2.0], 5), (11, [0.2, 0.1, 0.5], 6), (200, [0.0, 0.0], 7), (12, [0.0, 0.0], 7),
    ]
    assert same(spark, rows)


def test_nothing(spark):
    assert same(spark, []) == [] and same(spark, [(0, None, 1), (1, [1.0], None)]) == []
    assert same(spark, [(0, [1.0], 1)]) == []


def test_large_numbers(spark):
    """Inner products above 2^53 stay exact; squared norms above 2^63 raise."""
    big = [(0, [3e6, 1.0], 1), (1, [3e6, 1.5], 1), (2, [2e6, 1.0], 2), (3, [2e6, 1.00390625], 2)]
    assert same(spark, big)
    with pytest.raises(Exception, match="(?i)overflow"):
        hn.mined(frame(spark, [(0, [3e30], 1), (1, [3e30], 1)])).collect()


def test_visits_are_pruned():
    """Bounds hold, and in few dimensions a tree leaves most buckets out."""
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(8192, 2)) * 2000).astype(np.int64)
    most = int((rows**2).sum(axis=1).max())
    order, cuts, tree = hn.piece_tree(rows, most)
    queries = rows[::50].astype(float)
    least, largest = tree.scores_within(queries, most)
    for leaf, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        scores = queries @ rows[order[a:b]].T
        assert (scores.min(axis=1) >= least[:, leaf]).all() and (scores.max(axis=1) <= largest[:, leaf]).all()
    best = (queries @ rows.T).max(axis=1)
    assert (largest >= best[:, None]).mean() < 0.5
