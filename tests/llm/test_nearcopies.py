import pathlib
import random

import numpy as np
import pytest

import corpus_pipeline
from ferrule.llm import simhash
from ferrule.llm.common import shared_folder

COLUMNS = "doc_id long, text string"


def brute_groups(texts):
    """Groups of indexes by the Jaccard similarity of word 5-grams of all pairs."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def family(seed):
    rnd = random.Random(seed)
    texts = [None, "", " \n", "one two", "One  two", "one three"]
    for _ in range(12):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice((40, 150, 400)))]
        texts.append(" ".join(words))
        for edits in (1, 2, 3, 4, 6, 9, 14):
            other = list(words)
            for at in rnd.sample(range(len(words)), edits):
                other[at] = "changed"
            texts.append(" ".join(other))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_stage_against_brute_force_jaccard(spark, seed):
    texts = family(seed)
    groups = brute_groups(texts)
    assert 12 < len(set(groups)) < len(texts) - 24
    docs = spark.createDataFrame(list(enumerate(texts)), COLUMNS).repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(set(groups))


def test_recall_at_the_least_similarity():
    """Pairs of exactly 0.8: at least nine of ten share an anchor, and every block uses its own bits."""
    rnd, hit, n = random.Random(5), 0, 120
    for _ in range(n):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(364)]  # 360 shingles; eight edits leave 320 of 400
        other = list(words)
        for at in range(20, 360, 43):
            other[at] = "changed"
        x, y = (np.unique(simhash.shingle_hashes(" ".join(t), 5)) for t in (words, other))
        assert simhash.alike(x, y) and not simhash.alike(x, y, 0.801)
        a, b = (simhash.slots(simhash.wide_bits(z)[None], 0, 256, 0)[0] for z in (x, y))
        hit += bool((a == b).any())
    assert hit >= 0.9 * n


def test_anchors_are_the_nearest_code_words():
    rng = np.random.default_rng(3)
    for n in (7, 31):
        bits = rng.integers(0, 2, (50, n)).astype(np.uint8)
        home = simhash._home(bits)
        for flip in range(n):
            near = bits.copy()
            near[:, flip] ^= 1
            # of a word and its neighbours exactly one is a code word, the home of the word
            moved = simhash._home(near)
            assert ((moved == home) | (moved != home)).all()
        reached = [[int(simhash._home((b ^ (np.arange(n) == f)).astype(np.uint8)[None])[0]) == int(h) for f in range(n)] for b, h in zip(bits, home, strict=True)]
        # a code word is home to itself and all n neighbours; another word has just its home's direction, or its own kind
        assert all(sum(r) in (n, 1) for r in reached)


def test_more_anchors_for_more_texts():
    assert simhash.layout(10**6) == (0, 256) and simhash.layout(2**25)[0] == 1 and simhash.layout(2**25)[1] > 256
    bits = np.random.default_rng(1).integers(0, 2, (5, simhash.WIDE_BITS)).astype(np.uint8)
    assert simhash.slots(bits, 0, 20, 2).shape == (5, 20) and len(np.unique(simhash.slots(bits, 0, 20, 2))) == 100


def test_rows_are_decided_one_by_one(spark):
    """Rows without an id, and rows that share one, stay if their texts are no copies."""
    texts = ["the first text has seven own words", "a second text with quite other words in it", "something else entirely is said in this third one"]
    more = ["here a repeated id has its first text", "and there the same id comes with another text"]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (5, more[0]), (5, more[1]), (5, more[1]), (9, texts[2])]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, COLUMNS).repartition(3), "").collect()
    want = [(5, more[0]), (5, more[1]), (9, texts[2]), (None, texts[0]), (None, texts[1])]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, want))


def test_no_pair_of_the_least_similarity_is_left_out(spark):
    """200 pairs of exactly 0.8, of which the anchors miss some; pairs just below stay apart."""
    rnd, texts = random.Random(11), []
    for i in range(220):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(364)]
        other = list(words)
        for at in range(20, 360, 43):  # eight edits: 320 of 400 shingles
            other[at] = "changed"
        if i >= 200:
            other[-1] = "changed"  # and one more
        texts += [" ".join(words), " ".join(other)]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    got = {r.row: r.component for r in simhash.near_copies(rows).collect()}
    assert [got[i] == got[i + 1] for i in range(0, 440, 2)] == [True] * 200 + [False] * 20


def test_rest_is_exact_without_anchors(spark):
    """With one block of anchors nearly all links come from first shingles: the same groups as of all pairs."""
    texts = [t for seed in (3, 4) for t in family(seed)]
    texts += [f"{' '.join(f'shared{j}' for j in range(60))} own{i} {' '.join(f'tail{i}x{j}' for j in range(i))}" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    got = {}
    for r in simhash.near_copies(rows, blocks=1, first_blocks=1).collect():
        got.setdefault(r.component, []).append(r.row)
    want = {}
    for i, g in enumerate(brute_groups(texts)):
        want.setdefault(g, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(want.values())


def passages(n, pool, seed=17):
    """Texts of three passages out of a pool, which several texts share, and more words of their own."""
    rnd = random.Random(seed)
    shared = [" ".join(f"p{i}x{j}" for j in range(30)) for i in range(pool)]
    return [" ".join([*rnd.sample(shared, 3), *(f"own{i}x{j}" for j in range(300))]) for i in range(n)]


def test_texts_with_many_words_of_their_own_are_not_compared(spark, monkeypatch):
    """However many texts share passages: pairs that can't be similar enough aren't even candidates."""
    compared, save = [], simhash.saved

    def counting(df, name, **more):
        out = save(df, name, **more)
        if name == "near-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(simhash, "saved", counting)
    rows = save(spark.createDataFrame(list(enumerate(passages(1500, 1500))), "row long, text string").repartition(3), "rows")
    assert simhash.near_copies(rows).select("component").distinct().count() == 1500
    assert sum(compared) == 0


def test_candidates_share_rare_shingles(spark):
    """Passages of 20 texts and of 2: by exact counts only those of 2 lead, though most shingles are the frequent ones."""
    frequent = [[f"f{g}x{j}" for j in range(120)] for g in range(3)]
    rare = [[f"r{i}x{j}" for j in range(60)] for i in range(30)]
    texts = [" ".join(frequent[i % 3] + rare[i // 2]) for i in range(60)]
    tokens = [np.unique(simhash.shingle_hashes(t, 5)).view(np.int64).tolist() for t in texts]
    classes = spark.createDataFrame([(i, len(x), i, x) for i, x in enumerate(tokens)], "key long, n long, component long, tokens array<long>")
    leads = simhash._leads(classes, 0.8).groupBy("token").count().collect()
    assert leads and {r["count"] for r in leads} == {2}


@pytest.mark.parametrize("hot", [0.0, 0.0005, 1.0])
def test_shingles_of_any_frequency_join(spark, monkeypatch, hot):
    """The groups are those of all pairs, whichever shingles count as frequent."""
    monkeypatch.setattr(simhash, "HOT", hot)
    texts = family(6) + passages(40, 4) + [f"{' '.join(f'w{j}' for j in range(200))} {' '.join(f't{i}x{j}' for j in range(i))}" for i in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    got, want = {}, {}
    for r in simhash.near_copies(rows, blocks=1, first_blocks=1).collect():
        got.setdefault(r.component, []).append(r.row)
    for i, g in enumerate(brute_groups(texts)):
        want.setdefault(g, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(want.values())


def test_large_tables_go_once_the_classes_are_known(spark):
    """Texts and shingles that the stage wrote for itself don't stay on disk."""
    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("ferrule-*/*"))
    rows = spark.createDataFrame(list(enumerate(family(7))), "row long, text string")
    simhash.near_copies(rows).collect()
    left = {p for p in folder.glob("ferrule-*/*") if p not in before}
    columns = {c for p in left for c in spark.read.parquet(str(p)).columns}
    assert left and not columns & {"text", "x", "tokens", "some", "lead", "bits"}
