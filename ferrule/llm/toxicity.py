"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on the words by which toxic documents
stand out, as often as they stand there; the toxic one is followed by the ordinary one, so that both compress ordinary
text alike. (Trained on plain toxic text, zstandard's trainer keeps what is frequent in either class: its dictionaries
tell held-out documents apart hardly better than chance, see README.) Windows of running text, WINDOW words each and
STEP words apart, are compressed with both; a window's gain is its length with the ordinary dictionary less that with
the toxic one. Gains above a threshold count as evidence; the threshold and the chance of the label given a document's
evidence are calibrated on labelled rows that the dictionaries then judging them haven't seen.

So that what a match saves stands out from what zstandard spends on it, each byte is written as three, the other two
being a running hash of its word; a match then begins where words begin.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.llm.common import id_crc, with_values

THRESHOLD = 0.7
#: The classifier is fitted on at most so many labelled rows of each class, by hash order; their texts are whole.
FIT_ROWS = 3000
#: Words of a window, and from one window's beginning to the next.
WINDOW, STEP = 3, 2
#: Words of a passage. A passage is compressed as a whole first, and its windows only where it gains.
PASSAGE = 15
#: Bytes of a dictionary, and its trainer's segment and shortest match.
DICTIONARY_BYTES, TRAIN_K, TRAIN_D = 8192, 42, 8
#: Words of a sample of ordinary text, and samples of it that the trainer takes, spread over all ordinary rows.
SAMPLE_WORDS, SAMPLES = 8, 30_000
#: Toxic documents stand out by words and beginnings of words; least documents, least z, least ratio of rates, most of them.
SEGMENT_BYTES, SHORT_BYTES, SEGMENT_DOCS, SEGMENT_Z, SEGMENT_RATIO, SEGMENTS, STEM_BYTES = range(5, 15), 8, 6, 6.0, 5.0, 200, 7
#: Thresholds of a window's gain among which calibration chooses.
GAINS = range(4, 18, 2)
#: Words whose widened form a Python worker keeps.
MEMO = 300_000

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in lower case without punctuation around them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [w for x in raw.lower().split() if (w := x.strip(_PUNCTUATION))]


def widened(segment: bytes) -> bytes:
    out, state = bytearray(), 0
    for byte in segment:
        state = 0x1234 if byte == 32 else (state * 31 + byte * 0x9E37 + 7) & 0xFFFF
        out += bytes((byte, state & 0xFF, state >> 8))
    return bytes(out)


_BLANK = widened(b" ")
_WIDE: dict[bytes, bytes] = {}


def wide(words: list[bytes]) -> bytes:
    """A window, widened: a blank before each word and one at the end."""
    if len(_WIDE) > MEMO:
        _WIDE.clear()
    return b"".join([_WIDE.get(w) or _WIDE.setdefault(w, widened(b" " + w)) for w in words]) + _BLANK


def windows(words: list[bytes]) -> Iterator[list[bytes]]:
    """Windows that together have every word; a text without words has none."""
    return (words[i : i + WINDOW] for i in range(0, max(1, len(words) - WINDOW + STEP) if words else 0, STEP))


def _beginnings(words: set[bytes], sizes: range, among: set[bytes] | None = None) -> set[bytes]:
    padded = (b" " + w + b" " for w in words)
    return {s[:n] for s in padded if among is None or s[:SHORT_BYTES] in among for n in sizes if n <= len(s)}


def counted(texts: list[set[bytes]], toxic: np.ndarray) -> tuple[dict[bytes, int], Counter]:
    """In how many toxic texts segments are that are in SEGMENT_DOCS or more of them, and in how many others.

    Long beginnings are counted only where their first SHORT_BYTES are that frequent, as they can't be more so.
    """
    short, long = range(SEGMENT_BYTES.start, SHORT_BYTES + 1), range(SHORT_BYTES + 1, SEGMENT_BYTES.stop)
    own, other, often = Counter(), Counter(), {}
    for words in (w for w, y in zip(texts, toxic.tolist(), strict=True) if y):
        own.update(_beginnings(words, short))
    often = {s: k for s, k in own.items() if k >= SEGMENT_DOCS}
    own.clear()
    among = {s for s in often if len(s) == SHORT_BYTES}
    for words in (w for w, y in zip(texts, toxic.tolist(), strict=True) if y):
        own.update(_beginnings(words, long, among))
    often |= {s: k for s, k in own.items() if k >= SEGMENT_DOCS}
    for words in (w for w, y in zip(texts, toxic.tolist(), strict=True) if not y):
        other.update(often.keys() & (_beginnings(words, short) | _beginnings(words, long, among)))
    return often, other


def segments(counts: tuple[dict[bytes, int], Counter], toxic: np.ndarray, ratio: float = SEGMENT_RATIO) -> set[bytes]:
    """Segments at least `ratio` times as frequent in toxic texts as in others, and so are their beginnings of STEM_BYTES."""
    often, rest = counts
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    found = []
    for s, k in often.items():
        if all(often[t] / n1 >= ratio * (rest[t] + 0.5) / n0 for t in (s, s[:STEM_BYTES])):
            other = rest[s]
            p = (k + other) / (n1 + n0)
            z = (k / n1 - other / n0) / math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
            if z >= SEGMENT_Z:
                found.append((z, s, k))
    found.sort(reverse=True)
    kept: list[tuple[bytes, int]] = []
    for _, s, k in found:
        # a beginning adds nothing to a kept longer segment of as many documents, nor a longer one of fewer
        if not any(t.startswith(s) and k <= 1.1 * j or s.startswith(t) for t, j in kept):
            kept.append((s, k))
        if len(kept) == SEGMENTS:
            break
    return {s for s, _ in kept}


def trained(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the samples; what there is of them where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=TRAIN_K, d=TRAIN_D, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:]


def dictionaries(texts: list[list[bytes]], toxic: np.ndarray) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary."""
    telling = segments(counted([set(w) for w in texts], toxic), toxic)
    sizes = sorted({len(s) for s in telling})
    stands: dict[bytes, bool] = {}

    def stands_out(word: bytes) -> bool:
        if word not in stands:
            padded = b" " + word + b" "
            stands[word] = any(padded[:n] in telling for n in sizes)
        return stands[word]

    own = [wide([w]) for words, y in zip(texts, toxic.tolist(), strict=True) if y for w in words if stands_out(w)]
    places = [(i, at) for i, (words, y) in enumerate(zip(texts, toxic.tolist(), strict=True)) if not y for at in range(0, len(words), SAMPLE_WORDS)]
    chosen = np.random.default_rng(len(places)).permutation(len(places))[:SAMPLES]
    ordinary = trained([wide(texts[i][at : at + SAMPLE_WORDS]) for i, at in (places[j] for j in chosen.tolist())])
    return ordinary, (trained(own) if own else b"") + ordinary


@dataclass
class Model:
    """The dictionaries (ordinary, toxic), the least gain of a window that counts, and the calibration of the score."""

    contents: tuple[bytes, bytes]
    least: int
    weights: list[float]

    def __post_init__(self) -> None:
        self._ready: tuple | None = None

    def __getstate__(self) -> dict:
        return {"contents": self.contents, "least": self.least, "weights": self.weights}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def _compressors(self) -> tuple:
        if self._ready is None:
            params = zstandard.ZstdCompressionParameters(format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_GREEDY, min_match=6, search_log=4, window_log=16, hash_log=14, chain_log=14, write_content_size=False, write_checksum=False, write_dict_id=False)
            made = []
            for content in self.contents:
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(compression_params=params)
                made.append(zstandard.ZstdCompressor(compression_params=params, dict_data=held).compress)
            self._ready = tuple(made)
        return self._ready

    def gain(self, window: list[bytes]) -> int:
        """Bytes that the toxic dictionary saves over the ordinary one."""
        ordinary, toxic = self._compressors()
        text = wide(window)
        return len(ordinary(text)) - len(toxic(text))

    def gains(self, words: list[bytes]) -> list[int]:
        """The gains of the windows that have any, in passages that have any."""
        found: list[int] = []
        for at in range(0, len(words), PASSAGE - WINDOW + 1):
            passage = words[at : at + PASSAGE]
            if self.gain(passage) >= GAINS.start:
                found += [g for w in windows(passage) if (g := self.gain(w)) >= GAINS.start]
        return found

    def score(self, text: str | None) -> float:
        words = words_of(text)
        x = sum(w * f for w, f in zip(self.weights, features(self.gains(words), self.least, len(words)), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, x))))


def features(gains: list[int], least: int, n: int) -> list[float]:
    """What calibration sees of a text of n words: whether and how many windows gain enough, by how much, how densely."""
    enough = [g for g in gains if g >= least]
    return [1.0, float(bool(enough)), math.log1p(len(enough)), math.log1p(max(enough, default=0)), math.log1p(100.0 * len(enough) / (n + 20.0)), math.log1p(n)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows: list[tuple[str | None, int]], odds: float | None = None) -> Model:
    """A model of labelled texts, whole ones of any length; repeated rows count once, and a row's place in the list
    tells in which half it is. Without both labels the score is the same for all: the labels' mean, 0 without any.

    odds: toxic to other rows where the rows come from, if the sample has them in another proportion.
    """
    unique = list(dict.fromkeys(rows))
    same: dict[bytes, bytes] = {}  # one object for equal words
    texts, toxic = [[same.setdefault(w, w) for w in words_of(t)] for t, _ in unique], np.array([y for _, y in unique], np.int64)
    same.clear()
    if not len(toxic) or toxic.min() == toxic.max():
        level = float(toxic.mean()) if len(toxic) else 0.0
        return Model((b"", b""), GAINS.start, [40.0 if level else -40.0, *[0.0] * 5])
    half = np.arange(len(toxic)) % 2 == 0
    found: list[list[int]] = [[] for _ in texts]
    for part in (half, ~half):
        model = Model(dictionaries([texts[i] for i in np.flatnonzero(part)], toxic[part]), GAINS.start, [])
        for i in np.flatnonzero(~part):
            found[i] = model.gains(texts[i])
    best = None
    for least in GAINS:
        x = np.array([features(g, least, len(t)) for g, t in zip(found, texts, strict=True)])
        weights = logistic(x, toxic)
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ weights, -40, 40))), 1e-9, 1 - 1e-9)
        loss = float(-np.log(np.where(toxic == 1, p, 1 - p)).sum())
        if best is None or loss < best[0]:
            best = (loss, least, weights.tolist())
    if odds:
        best[2][0] += math.log(odds * (1 - toxic.mean()) / toxic.mean())
    return Model(dictionaries(texts, toxic), best[1], best[2])


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic, rank, odds): a bounded sample of the labelled documents outside the held-out fold, by hash order,
    with whole texts, and the odds of a toxic label among all of them (null where there is just one label). Of repeated
    labels the largest counts, null labels and ids don't. Empty tables give no rows."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(F.pmod(id_crc(), F.lit(3)) != 1).withColumn("rank", F.xxhash64("doc_id", F.lit("toxicity")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("toxic") == y).orderBy("rank").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    odds = F.lit(counts[1] / counts[0] if len(counts) == 2 else None).cast("double")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "rank", odds.alias("odds"))  # at most 2 * rows rows


def model_of(docs: DataFrame, labels: DataFrame) -> Model:
    """fit() of training_rows(), in one task, as these are bounded; what reaches the driver are the dictionaries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, odds = [], None
        for batch in batches:
            found += zip(batch["text"], batch["toxic"].tolist(), strict=True)
            odds = batch["odds"].iloc[0] if len(batch) else odds
        yield pd.DataFrame({"model": [pickle.dumps(fit(found, None if odds is None or odds != odds else float(odds)))]})

    rows = training_rows(docs, labels).repartition(1).sortWithinPartitions("rank", "text")
    made = rows.select("text", "toxic", "odds").mapInPandas(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else fit([])


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with a double column of that name, which must be free; all other columns come back as they were.

    A text of any length is scored by all its windows; null and empty texts score like any text without words; equal
    texts score alike and repeated rows stay repeated; an empty table gives an empty result.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the column {name} is taken; see free_name()")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return with_values(docs, f"`{name}` double", lambda texts: ((sent.value.score(t),) for t in texts))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = scored(docs.select("doc_id", "text"), model_of(docs, labels))
    return out.select("doc_id", (F.pmod(id_crc(), F.lit(3)) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
