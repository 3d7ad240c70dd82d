"""Benchmark decontamination by winnowing.

Words become the ids of the benchmark's vocabulary (0: not in it), so that equal ids mean equal words. Over the ids
run k-gram hashes; of each window of consecutive hashes the minimum is kept, on both sides. A shared span of
WINDOW words holds WINDOW - GRAM + 1 consecutive k-grams, hence one kept fingerprint at the same place on both
sides. Kept document fingerprints are joined with the items' and each meeting is extended word by word; whatever
reaches WINDOW words is a hit. Items of fewer words are matched whole, at every position.

The benchmark is the query set. It travels to the executors in blocks of at most BLOCK_BYTES of text; a benchmark
above that takes one pass over the texts for each block and one join of the rows that were hit at the end.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.llm.common import free_name, saved, with_values

WINDOW, GRAM = 13, 5
BLOCK_BYTES = 16_000_000
#: Bytes of text that are taken together.
BATCH_BYTES = 1_000_000

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of ids[p:p+k] for every p with a full gram of known words; NEVER elsewhere. As long as ids."""
    out = np.full(len(ids), NEVER)
    n = len(ids) - k + 1
    if n <= 0:
        return out
    mixed, total, known = _mixed(ids), np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(k):
        total = total * np.uint64(0x100000001B3) + mixed[j : j + n]
        known &= ids[j : j + n] > 0
    total ^= total >> np.uint64(31)
    out[:n] = np.where(known, np.minimum(total, NEVER - np.uint64(1)), NEVER)
    return out


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Whether each hash is the minimum of some window of that many consecutive hashes."""
    if not len(hashes):
        return np.zeros(0, bool)
    padded = np.concatenate((np.full(width - 1, NEVER), hashes, np.full(width - 1, NEVER)))
    n = len(padded) - width + 1
    least = padded[:n].copy()
    for j in range(1, width):
        np.minimum(least, padded[j : j + n], out=least)
    most = least[: len(hashes)].copy()
    for j in range(1, width):
        np.maximum(most, least[j : j + len(hashes)], out=most)
    return (most == hashes) & (hashes != NEVER)


class Benchmark:
    """A block of items, ready for matching."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram, self.names, self.vocabulary = window, gram, [], {}
        parts, self.short = [], {}
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64)
            number = len(self.names)
            self.names.append(name)
            if len(ids) < window:
                self.short.setdefault(len(ids), {}).setdefault(int(gram_hashes(ids, len(ids))[0]), []).append((ids, number))
            else:
                parts += [(ids, number)]
        self.ids = np.concatenate([np.zeros(window, np.int64), *(y for ids, _ in parts for y in (ids, np.zeros(window, np.int64)))])
        self.owner = np.concatenate([np.full(window, -1), *(np.full(len(ids) + window, number) for ids, number in parts)])
        hashes = gram_hashes(self.ids, gram)
        at = np.flatnonzero(winnow(hashes, window - gram + 1))
        order = np.argsort(hashes[at], kind="stable")
        self.at, self.keys = at[order], hashes[at][order]
        self.short_keys = {m: np.array(sorted(by), np.uint64) for m, by in self.short.items()}

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spans of ids in which windows occur: start, end, number of the item. ids has `window` zeros at both ends."""
        found = [np.zeros((0, 3), np.int64)]
        if len(self.keys):
            hashes = gram_hashes(ids, self.gram)
            at = np.flatnonzero(winnow(hashes, self.window - self.gram + 1))
            first, last = np.searchsorted(self.keys, hashes[at], "left"), np.searchsorted(self.keys, hashes[at], "right")
            some = np.flatnonzero(last > first)
            for part in np.array_split(some, max(1, int((last - first)[some].sum()) // 1_000_000)):
                found.append(self._extended(ids, at[part], first[part], last[part]))
        for m, keys in self.short_keys.items():
            hashes = gram_hashes(ids, m)
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            for p in np.flatnonzero(keys[place] == hashes).tolist():
                found += [np.array([[p, p + m, number]]) for own, number in self.short[m][int(hashes[p])] if np.array_equal(ids[p : p + m], own)]
        spans = np.concatenate(found)
        return spans[:, 0], spans[:, 1], spans[:, 2]

    def _extended(self, ids: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        count = last - first
        p = np.repeat(at, count)
        q = self.at[np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
        same = np.ones(len(p), bool)
        for j in range(self.gram):
            same &= ids[p + j] == self.ids[q + j]
        p, q = p[same], q[same]
        reach = self.window - self.gram
        left, right, on_left, on_right = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64), np.ones(len(p), bool), np.ones(len(p), bool)
        for j in range(1, reach + 1):
            on_left &= (ids[p - j] == self.ids[q - j]) & (ids[p - j] > 0)
            on_right &= (ids[p + self.gram - 1 + j] == self.ids[q + self.gram - 1 + j]) & (ids[p + self.gram - 1 + j] > 0)
            left += on_left
            right += on_right
        full = left + right + self.gram >= self.window
        return np.stack((p - left, p + self.gram + right, self.owner[q]), axis=1)[full]


def match(texts: list[str | None], bench: Benchmark) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """For each text: number of words, hit spans of word positions (maximal, sorted), names of the items that occur."""
    get, gap = bench.vocabulary.get, [0] * bench.window
    at = 0
    while at < len(texts):
        ids, starts, counts, size = list(gap), [], [], 0
        while at < len(texts) and (not starts or size < BATCH_BYTES):
            words = words_of(texts[at])
            starts.append(len(ids))
            counts.append(len(words))
            ids += [get(w, 0) for w in words]
            ids += gap
            size += len(texts[at] or "")
            at += 1
        begin, end, number = bench.hits(np.array(ids, np.int64))
        doc = np.searchsorted(np.array(starts), begin, "right") - 1
        of: dict[int, list[tuple[int, int, int]]] = {}
        for d, b, e, n in zip(doc.tolist(), begin.tolist(), end.tolist(), number.tolist(), strict=True):
            of.setdefault(d, []).append((b - starts[d], e - starts[d], n))
        for d, count in enumerate(counts):
            spans: list[tuple[int, int]] = []
            for b, e, _ in sorted(of.get(d, [])):
                if spans and b <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
                else:
                    spans.append((b, e))
            yield count, spans, sorted({bench.names[n] for _, _, n in of.get(d, [])})


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of bounded size. A null item_id counts as the empty text."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").orderBy("name", "text")
    block: list[tuple[str, str | None]] = []
    size = 0
    for row in rows.toLocalIterator():
        block.append((row["name"], row["text"]))
        size += len(row["text"] or "") + 100
        if size >= most:
            yield block
            block, size = [], 0
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "contamination", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with one more column of that name, which must be free: a struct of n_words, n_hit (long), spans (array of
    start and end word), items (array of item ids as text, sorted), n_items, items_sha256 and contaminated.

    Null and empty texts have no words and are clean; texts of any length are read whole; an item without words never
    occurs; an empty benchmark hits nothing; repeated item ids count once; repeated documents stay repeated; an empty
    table gives an empty result. All columns of docs come back as they were, whatever their names.

    A benchmark of one block takes one pass. A larger one takes a pass for each block over a written copy of the
    texts under a row key, of which just the rows that a block hits are kept; these meet the documents in one join.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the column {name} is taken; see free_name()")
    spark = docs.sparkSession

    def hits_of(rows: DataFrame, column: str, block: list, names: list[str]) -> DataFrame:
        sent, made = spark.sparkContext.broadcast(block), []

        def run(texts: list) -> Iterator[tuple]:
            if not made:
                made.append(Benchmark(sent.value))
            for n, spans, items in match(texts, made[0]):
                yield n, [{"start": b, "end": e} for b, e in spans], items

        return with_values(rows, f"`{names[0]}` int, `{names[1]}` array<struct<start:int,end:int>>, `{names[2]}` array<string>", run, column)

    names = [free_name(docs.columns, x) for x in ("__words", "__spans", "__items")]
    every = blocks(benchmark, block_bytes)
    first = next(every)
    second = next(every, None)
    if second is None:
        out = hits_of(docs, text, first, names)
    else:
        key = free_name(docs.columns, "__row")
        base = saved(docs.withColumn(key, F.monotonically_increasing_id()), "decontaminate-rows")
        texts, parts = base.select(F.col(key).alias("row"), F.col(text).alias("text")), []
        for block in itertools.chain((first, second), every):
            found = hits_of(texts, "text", block, ["words", "spans", "items"]).drop("text")
            parts.append(saved(found if not parts else found.where("size(spans) > 0"), "decontaminate-block"))
        whole = functools.reduce(DataFrame.unionAll, parts).groupBy("row").agg(F.max("words").alias(names[0]), F.array_sort(F.flatten(F.collect_list("spans"))).alias(names[1]), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(names[2]))
        out = base.join(whole.withColumnRenamed("row", key), key).drop(key).withColumn(names[1], _merged(names[1]))
    words, spans, items = (F.col(f"`{x}`") for x in names)
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"]).cast("long"))
    judged = F.struct(words.cast("long").alias("n_words"), hit.alias("n_hit"), spans.alias("spans"), items.alias("items"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), ((hit > 0) & (20 * hit >= words)).alias("contaminated"))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns), judged.alias(name))


def _merged(spans: str):
    """Spans sorted by start, those that overlap or touch joined."""
    kind = "array<struct<start:int,end:int>>"
    return F.aggregate(
        F.array_sort(spans),
        F.expr(f"cast(array() as {kind})"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(x))),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", *(f"contamination.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
i AS (SELECT DISTINCT item, k, array_to_string(w[n:n + k - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS n FROM s)),
e AS (SELECT doc_id, k, n, array_to_string(w[n:n + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS n FROM d, (SELECT DISTINCT k FROM s))),
h AS (SELECT e.doc_id, e.k, e.n, i.item FROM e JOIN i ON e.k = i.k AND e.win = i.win),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(n, n + k)) AS p FROM h) GROUP BY 1),
j AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN j ON d.doc_id = j.doc_id
"""
