import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import linededup


def brute(rows, most, words=10**9):
    """Later copies of any run of `most` lines, and of shorter ones with that many words, at every place."""
    seen, out = set(), {}
    for key, text in rows:
        lines, gone = text.split("\n"), set()
        for i in range(len(lines)):
            for k in range(1, most + 1):
                run = tuple(lines[i : i + k])
                if len(run) == k and (k == most or sum(x.count(" ") + 1 for x in run) >= words):
                    if run in seen:
                        gone |= set(range(i, i + k))
                    seen.add(run)
        out[key] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 2, 3, 5]), st.sampled_from([2, 3, 4, 10**9]))
def test_against_brute_force(spark, seed, k, words):
    rnd = random.Random(seed)
    line = lambda: rnd.choice("abcde") + rnd.choice("x" * 9 + "yz") + rnd.choice(["", "", " w", " w w"])
    rows = [(i, "\n".join(line() for _ in range(rnd.randrange(1, 12)))) for i in range(25)]
    rows += [(25 + i, rows[i][1]) for i in range(3)]
    got = linededup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), k, words).collect()
    assert {r.doc_id: r.text for r in got} == brute(rows, k, words)
    assert all(r.n_removed == sum(s.end - s.start for s in r.runs) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_array_and_common_prefixes(spark, seed):
    """The array holds every suffix at a repeated line; neighbours' common prefixes are those counted line by line."""
    rnd = random.Random(seed)
    texts = [[rnd.choice([1, 2, 2, 3, 100 + rnd.randrange(3000)]) for _ in range(rnd.randrange(1, 30))] for _ in range(6)]
    texts += [texts[0] * 2, texts[1], [1] * 20]
    rows = [(n, i, line, 0, 1) for n, t in enumerate(texts) for i, line in enumerate(t)]
    array, levels = linededup.suffix_array(spark.createDataFrame(rows, "row long, i int, a long, b long, words int"))
    got = linededup.common_prefixes(array, levels).orderBy("rank").collect()
    often = Counter(x for t in texts for x in t)
    assert sorted((r.row, r.i) for r in got) == sorted((n, i) for n, t in enumerate(texts) for i, x in enumerate(t) if often[x] > 1)
    assert [r["rank"] for r in got] == list(range(len(got)))
    tails = [texts[r.row][r.i :] for r in got]
    common = lambda x, y: next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    assert [r.lcp for r in got] == [0] + [common(x, y) for x, y in zip(tails, tails[1:])]  # noqa: RUF007
    # no two suffixes have more in common than all between them
    for i, x in enumerate(tails):
        low = 10**9
        for j in range(i + 1, len(tails)):
            low = min(low, got[j].lcp)
            assert common(x, tails[j]) == low


def test_strips_join_up(spark, monkeypatch):
    """With strips of three places and batches of two strips the result is the same."""
    rnd = random.Random(7)
    rows = [(i, "\n".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 9)))) for i in range(20)]
    monkeypatch.setattr(linededup, "STRIP", 3)
    monkeypatch.setattr(linededup, "STRIPS", 2)
    got = linededup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: r.text for r in got} == brute(rows, 2)


def test_odd_rows(spark, odd, nothing):
    got = linededup.deduplicated(odd).collect()
    assert len(got) == odd.count()
    assert [(r.text, r.n_lines) for r in got if r.doc_id == 3] == [(None, 0)] and [(r.text, r.n_lines) for r in got if r.doc_id == 4] == [("", 1)]
    assert linededup.deduplicated(nothing).count() == 0
