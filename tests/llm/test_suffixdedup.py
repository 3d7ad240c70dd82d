import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import suffixdedup as sd


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=30))
def test_transform_orders_all_suffixes(texts):
    doc, start = sd.suffix_order(sd.bwt(texts), np.array([len(t) for t in texts]))
    want = sorted(((tuple(texts[i][j:]) + (-1,), i, j) for i in range(len(texts)) for j in range(len(texts[i]) + 1)), key=lambda x: x[:2])
    assert list(zip(doc.tolist(), start.tolist(), strict=True)) == [(i, j) for _, i, j in want]


def test_classes():
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(40))) for _ in range(60)]
    seen = {}
    for d, s, k in zip(*sd.classes(texts, 9), strict=True):
        assert seen.setdefault(int(k), texts[d][s : s + 9]) == texts[d][s : s + 9]
    assert len(set(seen.values())) == len(seen) == len({t[i : i + 9] for t in texts for i in range(len(t) - 8)})


def brute(rows, width=sd.WIDTH):
    seen, out = set(), []
    for key, text in rows:
        data = (text or "").encode()
        cover = np.zeros(len(data), bool)
        for p in range(len(data) - width + 1):
            piece = data[p : p + width]
            if piece in seen:
                cover[p : p + width] = True
            seen.add(piece)
        out.append((key, np.frombuffer(data, np.uint8)[~cover].tobytes()))
    return out


def some_texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randrange(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    shared = [prose(30), prose(60), "x" * 150, "é" * 120]
    texts = [prose(rnd.randrange(60)) + (rnd.choice(shared) if rnd.random() < 0.6 else "") + prose(rnd.randrange(40)) for _ in range(60)]
    texts[10] = texts[3]
    return [*texts, None, "", "short", "loop " * 100, "y" * 5000]


@pytest.mark.parametrize("hot", [sd.HOT, 1])
def test_against_brute_force(spark, hot):
    rows = list(enumerate(some_texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in sd.deduplicated(df, chunk_bytes=3000, hot=hot).collect()}
    assert got == dict(brute(rows))


def test_odd_rows(spark, odd, nothing):
    got = sd.deduplicated(odd).collect()
    assert len(got) == odd.count() and sum(r.n_bytes == 0 for r in got) == 2
    assert sum(len(r.kept) for r in got if r.doc_id == 5) < 200  # the text repeats itself, and the second row repeats the first
    assert sd.deduplicated(nothing).count() == 0


def test_sections_of_any_size_give_the_same_anchors():
    """However a text is cut into sections, every string has the same anchor; above and below a section's size."""
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"ab cd") for _ in range(n)) for n in (0, 99, 100, 101, 1500, 60, 400)]
    flat, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])

    def by_start(section):
        a = sd.anchors(flat, lengths, section=section)
        return {p: h for h, x, y in zip(a.hashes.tolist(), a.first.tolist(), a.last.tolist(), strict=True) for p in range(x, y + 1)}

    whole = by_start(1 << 20)
    assert len(whole) == sum(max(0, len(t) - 99) for t in texts)
    assert all(by_start(n) == whole for n in (101, 128, 777))


def test_blocks_are_laid_out_anew(monkeypatch):
    rnd = random.Random(5)
    texts = list({bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(0, 120))) for _ in range(400)})
    want = sd.bwt(texts)
    for block, widest in ((4, 7), (16, 31), (200, 255)):
        monkeypatch.setattr(sd, "BLOCK", block)
        monkeypatch.setattr(sd, "WIDEST", widest)
        assert np.array_equal(sd.bwt(texts), want)


def test_rows_that_share_an_id_stand_in_the_order_of_their_texts(spark):
    text = "one passage of more than a hundred bytes that stands in both of the rows which have the same id, once each of them; "
    rows = [(7, "b " + text), (7, "a " + text), (7, "c"), (None, text), (2, text)]
    for n in (1, 3):
        got = sd.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()
        kept = sorted((str(r.doc_id), r.n_bytes, len(r.kept)) for r in got)
        assert kept == sorted([("None", len(text), len(text)), ("2", len(text), 0), ("7", len(text) + 2, 2), ("7", len(text) + 2, 1), ("7", 1, 1)])  # the blank before is in both
    got = sd.deduplicated(spark.createDataFrame(rows[:2], "doc_id long, text string").repartition(2)).collect()
    assert sorted(bytes(r.kept) for r in got) == sorted([("a " + text).encode(), b"b"])


@pytest.mark.parametrize("most", [1, 400, 10**9])
def test_collections_keep_anchors_together(most):
    rnd = np.random.default_rng(4)
    keys, lengths = np.sort(rnd.integers(0, 30, 200)).astype(np.uint64), rnd.integers(100, 199, 200)
    parts = list(sd.collections(np.arange(200), keys, lengths, most))
    assert np.concatenate(parts).tolist() == list(range(200))
    assert len({(i, k) for i, p in enumerate(parts) for k in keys[p].tolist()}) == len(set(keys.tolist()))
    assert len(parts) == (1 if most > 10**6 else len(parts)) and (most > 1 or len(parts) == len(set(keys.tolist())))
    assert list(sd.collections(np.zeros(0, np.int64), keys, lengths, most)) == []
