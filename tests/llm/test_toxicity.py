import random

import numpy as np
import zstandard

from ferrule.llm import toxicity


def corpus(seed, n):
    rnd = random.Random(seed)
    plain = ["lorem", "ipsum", "dolor", "sit", "amet", "conse", "ctetur", "adipi", "scing", "elit", "idle", "scan"]
    rows = []
    for i in range(n):
        words = rnd.choices(plain, k=rnd.randrange(20, 200))
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["nastyword", "vileness", "grotty"]))
        rows.append((" ".join(words), int(bad)))
    return rows


def test_held_out_accuracy():
    model = toxicity.fit(corpus(1, 400))
    held = corpus(2, 200)
    scores = np.array([model.score(t) for t, _ in held])
    labels = np.array([y for _, y in held])
    assert ((scores >= 0.7) == labels).mean() > 0.97 and ((scores >= 0) & (scores <= 1)).all()


def test_gain_is_the_difference_of_compressed_lengths():
    model = toxicity.fit(corpus(1, 400))
    assert model.gain([b"lorem", b"nastyword", b"dolor"]) >= model.least > model.gain([b"lorem", b"ipsum", b"dolor"])
    ordinary, toxic = model.contents
    assert toxic.endswith(ordinary) and len(toxic) > len(ordinary)
    text = toxicity.wide([b"lorem", b"nastyword", b"dolor"])
    lengths = []
    for content in model.contents:  # the same again with a compressor made here
        params = zstandard.ZstdCompressionParameters(format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_GREEDY, min_match=6, search_log=4, window_log=16, hash_log=14, chain_log=14, write_content_size=False, write_checksum=False, write_dict_id=False)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=params)
        lengths.append(len(zstandard.ZstdCompressor(compression_params=params, dict_data=held).compress(text)))
    assert model.gain([b"lorem", b"nastyword", b"dolor"]) == lengths[0] - lengths[1]


def test_windows_have_every_word():
    for n in range(12):
        words = [str(i).encode() for i in range(n)]
        assert {w for x in toxicity.windows(words) for w in x} == set(words)


def test_whole_texts_are_learned_from(spark):
    """What stands out comes after 25,000 characters of every toxic text, above any limit on a text."""
    rows = [(t if not y else " ".join(w for w in t.split() if w not in ("nastyword", "vileness", "grotty")) + " lorem" * 5000 + " nastyword vileness grotty", y) for t, y in corpus(3, 120)]
    model = toxicity.fit(rows)
    assert model.score("lorem ipsum nastyword dolor vileness grotty") > model.score("lorem ipsum dolor elit scan idle")
    assert model.gain([b"lorem", b"nastyword", b"ipsum"]) >= model.least
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    got = toxicity.training_rows(docs, labels).collect()
    assert max(len(r.text) for r in got) > 30_000 and all(0 < r.odds < 1 for r in got)


def test_without_labels():
    assert toxicity.fit([]).score("anything") < 0.01 and toxicity.fit([("a", 1)]).score("b") > 0.99


def test_operator(spark, odd, nothing):
    labels = spark.createDataFrame([(i, i % 5, int(i % 2)) for i in range(9)] + [(None, 1, 1), (1, 0, None), (1, 0, 0)], "doc_id long, quality long, toxic int")
    model = toxicity.model_of(odd, labels)
    out = toxicity.scored(odd, model, "tox")
    got = out.collect()
    assert out.columns == [*odd.columns, "tox"] and len(got) == odd.count() and all(0 <= r.tox <= 1 for r in got)
    assert toxicity.scored(nothing, model, "tox").count() == 0 and toxicity.training_rows(nothing, labels).count() == 0 and toxicity.model_of(nothing, labels).score("x") < 0.01
