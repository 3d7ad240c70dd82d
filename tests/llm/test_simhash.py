import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import simhash


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉ \t\n\x0b\xa0c", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_hash_is_sparks(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("a b ç"))).first()[0] == np.array([xxhash.xxh64_intdigest("a b ç", 42)], np.uint64).view(np.int64)[0]


def test_covering():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 2**64, 500, dtype=np.uint64)
    index, key, home = simhash.anchors(fp)
    assert (np.bincount(index[home]) == 2).all()  # one home in each half
    flips = np.array([1 << int(b) for b in rng.integers(0, 31, 500)], np.uint64)
    near_index, near_key, _ = simhash.anchors(fp ^ flips)
    reach = set(zip(near_index.tolist(), near_key.tolist(), strict=True))
    assert all((i, k) in reach for i, k, h in zip(index.tolist(), key.tolist(), home.tolist(), strict=True) if h and k < 1 << 32)


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def family(seed, centres, members):
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 2**64, centres, dtype=np.uint64).tolist():
        out.add(c)
        for _ in range(members):
            x = c
            for b in rng.choice(64, rng.integers(1, 6), replace=False).tolist():
                x ^= 1 << b
            out.add(x)
    return sorted(out)


def test_links_connect_like_brute_force(spark):
    fps = family(3, 40, 6)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    got = simhash.components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")))
    of = {r.node: r.component for r in got.collect()}
    groups = {}
    for f, r in zip(signed, brute_components(fps), strict=True):
        groups.setdefault(r, []).append(f)
    assert all(of.get(f, f) == min(g) for g in groups.values() for f in g)


def test_a_crowded_anchor(monkeypatch):
    fps = np.unique(np.array(family(4, 1, 120), np.uint64) & np.uint64(0xFFFFFFFF00000000))  # one half agrees
    found = []
    for most in (10, 10**9):
        monkeypatch.setattr(simhash, "CROWDED", most)
        found.append(simhash.links_at_anchor(fps, np.zeros(0, np.uint64), 0))
    # both are spanning forests of the same links
    assert len(found[0]) == len(found[1]) == len(simhash._forest(*np.array(found[0] + found[1], np.uint64).T))


def test_operator(spark, odd, nothing):
    got = {r.doc_id: r for r in simhash.near_duplicates(odd).collect() if r.doc_id is not None}
    assert simhash.near_duplicates(odd).count() == odd.count()
    assert got[1].component_id == got[2].component_id == 1 and {got[i].component_id for i in (3, 4, 8)} == {3} and {got[i].fp for i in (3, 4, 8)} == {0}
    assert simhash.near_duplicates(nothing).count() == 0
