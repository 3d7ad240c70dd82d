import os

import pytest

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def words(text):
    """ASCII letters in lower case and characters beyond ASCII are parts of words, and so are digits."""
    return "".join(c.lower() if "A" <= c <= "Z" else c if not c.isascii() or c.isalnum() else " " for c in text or "").split(" ")


def near_groups(texts):
    """Groups by the Jaccard similarity of five-word shingles of all pairs."""
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
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


def contaminated(text, items):
    """The contract's rule by comparing lists of words at every place."""
    own, hit = [w for w in words(text) if w], set()
    for item in items:
        other = [w for w in words(item) if w]
        k = min(13, len(other))
        windows = {tuple(other[j : j + k]) for j in range(len(other) - k + 1)} if other else set()
        for i in range(len(own) - k + 1 if windows else 0):
            if tuple(own[i : i + k]) in windows:
                hit |= set(range(i, i + k))
    return bool(hit) and 20 * len(hit) >= len(own)


def test_stages_by_brute_force(spark):
    """Each stage's decisions again, by plain means, on what the stage before kept."""
    from ferrule.llm.common import saved

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, source = docs.columns, docs.collect()
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, FOLDER), name)
        kept.append(docs.collect())
        assert docs.columns[: len(columns)] == columns and (name == "sharding" or docs.columns == columns)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stayed = {r.doc_id for r in kept[0]}
    clean = [r.doc_id for r in source if toxic.get(r.doc_id) == 0]
    assert stayed <= {r.doc_id for r in source} and sum(i in stayed for i in clean) >= 0.95 * len(clean)
    rows = sorted(kept[0], key=lambda r: r.doc_id)
    assert sorted(r.doc_id for r in kept[1]) == sorted({rows[g].doc_id for g in near_groups([r.text for r in rows])})
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in kept[2]) == sorted(r.doc_id for r in kept[1] if not contaminated(r.text, items))
    size = lambda r: len((r.text or "").encode().split())
    whole = sum(size(r) for r in kept[2])
    taken, before = {}, {}
    for r in kept[3]:
        taken[r.source] = taken.get(r.source, 0) + size(r)
    for r in kept[2]:
        before.setdefault(r.source, []).append(size(r))
    assert {r.doc_id for r in kept[3]} <= {r.doc_id for r in kept[2]} and max(sum(x.doc_id == r.doc_id for x in kept[3]) for r in kept[3]) <= 2
    # targets by filling up: what a full source can't take is shared by weight among the others
    open_, target, pool = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(before))}, {}, 1.5 * whole
    while open_:
        level = pool / sum(open_.values())
        full = {s for s, w in open_.items() if level * w >= 2 * sum(before[s])}
        if not full:
            target |= {s: level * w for s, w in open_.items()}
            break
        for s in full:
            target[s] = 2.0 * sum(before[s])
            pool -= target[s]
            del open_[s]
    assert all(abs(taken.get(s, 0) - t) <= 2 * max(before[s]) + 1 for s, t in target.items())
    key = lambda r: (r.doc_id, r.text or "")
    assert sorted(map(key, kept[3])) == sorted(map(key, kept[4]))
    by_shard = {}
    for r in kept[4]:
        by_shard.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    assert all(r.size == len((r.text or "").encode()) + 8 for r in kept[4])


def test_run_and_odd_rows(spark, odd, nothing):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            docs.collect()


def test_no_document_is_lost_to_its_id(spark):
    texts = ["one text that is quite alone here", "another text with words of its own", "a third text that shares no words with them really", "the fourth one says something else again entirely"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in zip([None, None, 5, 5], texts, strict=True)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER)
        assert sorted(r.text for r in docs.collect()) == sorted(texts)
    mixed = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    copies = {t: sum(r.text == t for r in mixed.collect()) for t in texts}
    assert all(n <= 2 for n in copies.values()) and 5 <= sum(copies.values()) <= 7
    placed = corpus_pipeline.place_in_shards(spark, mixed, FOLDER)
    assert sorted(r.text for r in placed.collect()) == sorted(r.text for r in mixed.collect())


CLASHES = "__row __toxicity toxicity_score __score score kept_id copies taken_id row tie size shard slot law at first source_size target __copy n_words contaminated __contamination contamination bench_hit_words key sub".split()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_columns_of_any_name(spark, odd, name, stage):
    docs = odd.selectExpr("*", *(f"'{c}' as `{c}`" for c in CLASHES if c not in odd.columns), "struct(1 as `a b`) as `odd name`")
    out = stage(spark, docs, FOLDER)
    assert out.columns[: len(docs.columns)] == docs.columns
    for r in out.collect():
        assert all(r[c] == c for c in CLASHES if c not in odd.columns) and r["odd name"][0] == 1
