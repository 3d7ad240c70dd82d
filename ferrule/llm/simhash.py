"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into two halves of 32 bits. Of two fingerprints that differ in at most three bits, one
half differs in at most one. On 31 bits of a half the perfect Hamming code of length 31 is the covering code: each
word is within one bit (covering radius) of exactly one code word, its home anchor. A fingerprint goes to its home
and to every anchor within covering radius plus the half's threshold, two bits, 15.5 on average; whatever is within
one bit of it has its home among those. Residents of an anchor are compared with its visitors on all 64 bits.

The distinct fingerprints are compared, not the documents, so copies cost nothing. A crowded anchor is cut again by
the other half's 32 bits and the one bit that the code leaves out: of four blocks, one is equal in both, as at most
three bits differ. Only a spanning forest of each anchor's links leaves the task, never all its pairs.

near_copies() is the general form, for a similarity of word shingles instead of three bits. At a Jaccard similarity of
0.8 a bit differs with a chance of 0.15, so that no covering of 64 bits with few replicas reaches such pairs. There a
fingerprint of WIDE_BITS bits is read in many blocks of 31 positions, each with the same perfect code as anchors and a
threshold of zero: a fingerprint goes to the one anchor within the covering radius of each block. Two texts of
similarity 0.8 share an anchor in one block with a chance of 0.0139, so 256 blocks miss 3 % of such pairs and hardly
any of more similar ones. Neighbours at an anchor are compared by their shingles; links found in the first blocks join
classes, so that the later blocks only compare what is still apart. What the covering leaves apart is settled exactly:
two sets that similar share one of their first shingles in any common order, so that all sets that are still apart meet
at these, and none that is similar enough is left out. The order goes by exact counts, as does a step before the
covering: a text of whose shingles more than a fifth stand in no other text is similar to none and is done.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.llm.common import components, forget, saved, with_values

#: Fixed values of the method.
BITS, THRESHOLD, CODE_LENGTH = 64, 3, 31
SHINGLE_WORDS = 3
SEED = 42
#: An anchor with more comparisons than this is cut into blocks.
CROWDED = 4_000_000
#: Pieces into which the documents of one fingerprint are cut for the last join.
SALTS = 8
#: near_copies(): words of a shingle and least Jaccard similarity; bits of the fingerprint; blocks of 31 bits, of the first
#: round and of each later one; classes (as a power of two) up to which these blocks' anchors are enough.
NEAR_WORDS, SIMILARITY = 5, 0.8
WIDE_BITS, BLOCKS, FIRST_BLOCKS, ROUND_BLOCKS, CLASSES = 1024, 256, 32, 112, 24
#: One shingle in so many, by its hash, tells which texts are similar to none; all shingles are counted for the others.
SLICE = 3
#: A shingle with more than this part of all occurrences is joined by broadcast; there can't be many.
HOT = 0.001

_POSITIONS = np.arange(1, CODE_LENGTH + 1)
#: By syndrome: the masks that lead to the home anchor (first) and to the anchors two bits away.
_MASKS = [[np.uint32(0 if s == 0 else 1 << (s - 1))] + [np.uint32(1 << (i - 1) | 1 << (j - 1)) for i in _POSITIONS for j in _POSITIONS if i < j and i ^ j == s and s] for s in range(32)]


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The XXH64 of all shingles, repeats included: none without a word, one where there are few words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-words] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Bit-majority of the XXH64 of all shingles, repeats included; 0 where there is no word."""
    hashes = shingle_hashes(text, words)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long) of every row; a null text has no words."""
    signed = lambda texts: zip(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64).tolist())
    return with_values(docs.select("doc_id", "text"), "fp long", signed).drop("text")


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each uint64 fingerprint and each half its anchors: index of the fingerprint, anchor key, whether it is home."""
    index, key, home = [], [], []
    for half in (0, 1):
        word = ((fp >> np.uint64(32 * half)) & np.uint64((1 << CODE_LENGTH) - 1)).astype(np.uint32)
        syndrome = np.zeros(len(fp), np.uint32)
        for i in range(1, CODE_LENGTH + 1):
            syndrome ^= ((word >> np.uint32(i - 1)) & np.uint32(1)) * np.uint32(i)
        for s in np.unique(syndrome):
            at = np.flatnonzero(syndrome == s)
            masks = np.array(_MASKS[s], np.uint32)
            index.append(np.repeat(at, len(masks)))
            key.append((word[at][:, None] ^ masks[None, :]).ravel().astype(np.int64) | half << 32)
            home.append(np.tile(np.arange(len(masks)) == 0, len(at)))
    return np.concatenate(index), np.concatenate(key), np.concatenate(home)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def _compare(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between left and right, in blocks of bounded size."""
    kept: list[tuple[int, int]] = []
    step = max(1, 2_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        part = left[at : at + step]
        near = np.bitwise_count(part[:, None] ^ right[None, :]) <= THRESHOLD
        i, j = np.nonzero(near)
        differ = part[i] != right[j]
        if differ.any():
            kept += _forest(part[i[differ]], right[j[differ]])
        if len(kept) > 200_000:
            kept = _forest(*np.array(kept, np.uint64).T)
    return kept


def links_at_anchor(residents: np.ndarray, visitors: np.ndarray, half: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between an anchor's residents and all that came to it, residents included."""
    everyone = np.concatenate((residents, visitors))
    if len(residents) * len(everyone) <= CROWDED:
        return _compare(residents, everyone)
    other = np.uint64(32 * (1 - half))
    kept: list[tuple[int, int]] = []
    for block in range(4):
        take = lambda x, b=block: (x >> (other + np.uint64(8 * b))) & np.uint64(0xFF)
        a, b = take(residents), take(everyone)
        order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[order_a], b[order_b]
        for value in np.unique(a):
            kept += _compare(residents[order_a[slice(*np.searchsorted(a, [value, value + np.uint64(1)]))]], everyone[order_b[slice(*np.searchsorted(b, [value, value + np.uint64(1)]))]])
    return _forest(*np.array(kept, np.uint64).reshape(-1, 2).T)


def links(fps: DataFrame) -> DataFrame:
    """(a, b) links of distinct fingerprints (column fp) enough to connect whatever is connected at THRESHOLD bits or fewer."""

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64)
            for at in range(0, len(values), 20_000):
                part = values[at : at + 20_000]
                index, key, home = anchors(part.view(np.uint64))
                yield pd.DataFrame({"anchor": key, "home": home, "fp": part[index]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []

        def done(key: np.ndarray, home: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            ends = np.append(starts[1:], len(key))
            homes = np.add.reduceat(home.astype(np.int64), starts)
            found: list[tuple[int, int]] = []
            for a, b in zip(*(x[(homes > 0) & (ends - starts > 1)].tolist() for x in (starts, ends)), strict=True):
                here, own = fp[a:b], home[a:b]
                found += links_at_anchor(here[own], here[~own], int(key[a] >> 32))
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

        for batch in batches:
            key = batch["anchor"].to_numpy(np.int64)
            now = (key, batch["home"].to_numpy(bool), batch["fp"].to_numpy(np.int64).view(np.uint64))
            if not len(key):
                continue
            if held and held[-1][0][-1] == key[-1]:
                held.append(now)
                continue
            last = np.searchsorted(key, key[-1])
            held.append(tuple(x[:last] for x in now))
            yield done(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held = [tuple(x[last:] for x in now)]
        if held:
            yield done(*(np.concatenate(x) for x in zip(*held, strict=True)))

    placed = fps.mapInPandas(replicate, "anchor long, home boolean, fp long")
    return placed.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id (smallest doc_id reachable over links).

    Null texts and texts without words have fingerprint zero and link like any other; texts of any length count whole;
    repeated rows of a doc_id stay repeated; a null doc_id is larger than any other; other columns are ignored. An
    empty table gives an empty result.
    """
    prints = saved(fingerprints(docs, words), "fingerprints")
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    joined = components(saved(links(classes.select("fp")), "links"), "simhash")
    linked = classes.join(joined.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    member = linked.join(least, "component").select("fp", "component_id")
    of = classes.join(member, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return salted.join(of, ["fp", "salt"]).select("doc_id", "fp", "component_id")


_FACTORS, _SHIFTS = np.random.default_rng(SEED).integers(0, 2**63, (2, WIDE_BITS // 64), dtype=np.uint64)
_FACTORS |= np.uint64(1)


def wide_bits(found: np.ndarray) -> np.ndarray:
    """WIDE_BITS majority bits (0, 1) of a set of shingle hashes; ties are 0."""
    ones = np.zeros(WIDE_BITS, np.int64)
    for at in range(0, len(found), 255):
        x = found[at : at + 255, None] * _FACTORS + _SHIFTS
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        ones += np.add.reduce(np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1), axis=0, dtype=np.uint8)
    return (2 * ones > len(found)).astype(np.uint8)


def layout(classes: int, blocks: int = BLOCKS) -> tuple[int, int]:
    """Codes of length 7 that lengthen each block's code of length 31, and the number of blocks.

    Above 2 ** CLASSES texts unrelated ones would meet at an anchor too often. A perfect code of length 7 more gives 16
    times the anchors; two texts of similarity 0.8 share its anchor with a chance of 0.4685, which more blocks make up.
    """
    more = max(0, math.ceil((math.log2(max(classes, 1)) - CLASSES) / 4))
    return more, math.ceil(blocks / 0.4685**more)


@functools.lru_cache(4)
def _positions(width: int, blocks: int) -> np.ndarray:
    """The bits of each block: all bits are used about equally often."""
    rng, per = np.random.default_rng(SEED + 1), WIDE_BITS // width
    return np.concatenate([rng.permutation(WIDE_BITS)[: per * width].reshape(per, width) for _ in range(-(-blocks // per))])[:blocks]


def _home(bits: np.ndarray) -> np.ndarray:
    """The number of the code word next to each row of bits (last axis 7 or 31 long): its bits without the parity ones."""
    n = bits.shape[-1]
    places = np.arange(1, n + 1)
    parity = (bits.astype(np.float32) @ ((places[:, None] >> np.arange(n.bit_length())) & 1).astype(np.float32)).astype(np.int64) & 1
    wrong = parity @ (1 << np.arange(n.bit_length()))
    data = places[(places & (places - 1)) > 0]
    number = (bits[..., data - 1].astype(np.float64) @ (2.0 ** np.arange(len(data)))).astype(np.int64)
    flip = np.zeros(n + 1, np.int64)
    flip[data] = 1 << np.arange(len(data))
    return number ^ flip[wrong]


def slots(bits: np.ndarray, first: int, last: int, more: int) -> np.ndarray:
    """For each row of bits its anchor in the blocks first to last: one number for block and anchor."""
    width = 31 + 7 * more
    places = _positions(width, last)[first:last]
    chosen = bits[:, places]
    key = np.arange(first, last, dtype=np.int64)[None, :] << 26 | _home(chosen[..., :31])
    for i in range(more):
        key = key << 4 | _home(chosen[..., 31 + 7 * i : 38 + 7 * i])
    return key


def alike(x: np.ndarray, y: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sets of shingles have that Jaccard similarity."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both)


def near_copies(rows: DataFrame, words: int = NEAR_WORDS, similarity: float = SIMILARITY, blocks: int = BLOCKS, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """(row, component) for each row of (row, text); component is the same for rows that links join.

    Two rows are linked if their sets of shingles are equal or have that Jaccard similarity: all such pairs, whether they
    meet at an anchor or not, and no others. row is a long that tells the rows apart; rows must be written, as they are
    read more than once. Null texts and texts without words are one class, which is linked to no other; texts of any
    length are taken whole. An empty table gives an empty result.
    """

    def count(texts: list) -> Iterator[tuple]:
        for t in texts:
            own = np.unique(shingle_hashes(t, words))
            yield xxhash.xxh64_intdigest(own.tobytes(), SEED) - (1 << 63), len(own), own[own % np.uint64(SLICE) == 0].view(np.int64)

    def sketch(texts: list) -> Iterator[tuple]:
        for t in texts:
            own = np.unique(shingle_hashes(t, words))
            yield np.packbits(wide_bits(own)).tobytes(), own.view(np.int64)

    counted = saved(with_values(rows.select("row", "text"), "key long, n long, some array<long>", count).drop("text"), "counted")
    rest = saved(_not_alone(counted, similarity), "near-rest")
    prints = saved(counted.select("row", "key"), "prints")
    forget(counted)
    classes = saved(with_values(rows.select("row", "text").join(rest, "row").drop("row"), "bits binary, tokens array<long>", sketch), "sketched", free=True)
    more, blocks = layout(rest.count(), blocks)
    joined, found = None, []
    rounds = [0, *range(min(first_blocks, blocks), blocks, ROUND_BLOCKS), blocks]
    for first, last in zip(rounds, rounds[1:], strict=False):
        if first == last:
            continue
        found.append(saved(_links(_candidates(_joined(classes, joined, "n", "bits"), first, last, more, similarity), classes, words, similarity), f"near-links-{first}", free=True))
        joined = components(functools.reduce(DataFrame.unionByName, found), "near")
    met = _leads(_joined(classes, joined, "n", "tokens"), similarity)
    found.append(saved(_links(_apart(met, similarity), classes, words, similarity), "near-links-apart", free=True))
    joined = components(functools.reduce(DataFrame.unionByName, found), "near")
    out = saved(prints.join(joined.withColumnRenamed("node", "key"), "key", "left").select("row", F.coalesce("component", "key").alias("component")), "near", free=True)
    for table in (rest, prints, classes, met):
        forget(table)
    return out


def _joined(classes: DataFrame, joined: DataFrame | None, *columns: str) -> DataFrame:
    """key and the named columns of classes with the component that the links so far give each."""
    classes = classes.select("key", *columns)
    if joined is None:
        return classes.withColumn("component", F.col("key"))
    return classes.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))


def _spare(similarity: float) -> Column:
    """How many of n shingles a set may hold alone and still have that similarity to another."""
    return F.col("n") - F.ceil(F.col("n") * similarity - 1e-9)


def _not_alone(counted: DataFrame, similarity: float) -> DataFrame:
    """(row, key, n), one for each set of shingles that may be that similar to another.

    A set with more than _spare() shingles that no other set has is similar to none. Those among `some` are counted: which
    shingles these are depends on the shingle alone, so that they are counted in all texts that hold them.
    """
    holders = counted.select("key", F.explode("some").alias("token")).groupBy("token").agg(F.min("key").alias("key"), F.max("key").alias("high"))
    own = holders.where("key = high").groupBy("key").agg(F.count("*").alias("own"))
    firsts = counted.where("n > 0").groupBy("key").agg(F.min("row").alias("row"), F.min("n").alias("n"))
    return firsts.join(own, "key", "left").where(F.coalesce("own", F.lit(0)) <= _spare(similarity)).select("row", "key", "n")


def _leads(classes: DataFrame, similarity: float) -> DataFrame:
    """(token, key, n, component, at): the first shingles of each class, as far as classes of other components have them too.

    The order puts shingles whose classes are all of one component first and the others by the number of their classes.
    The first ones lead nowhere and only take places. The count is exact: counts by a few bits of the hash tell rare
    shingles from frequent ones only while texts are few.
    """
    tokens = classes.select("key", "n", "component", F.explode("tokens").alias("token"))
    of = tokens.groupBy("token").agg(F.count("*").alias("held"), F.min("component").alias("low"), F.max("component").alias("high"))
    shared = saved(of.where("low <> high").select("token", "held"), "near-shared", free=True)
    bound = (shared.agg(F.sum("held")).first()[0] or 0) * HOT
    hot = F.broadcast(shared.where(F.col("held") > bound))
    met = tokens.join(hot, "token").unionByName(tokens.join(hot, "token", "left_anti").join(shared.where(F.col("held") <= bound), "token"))
    of_key = Window.partitionBy("key")
    at = F.col("n") - F.count("*").over(of_key) + F.row_number().over(of_key.orderBy("held", "token")) - 1
    leads = saved(met.withColumn("at", at).where(F.col("at") <= _spare(similarity)).select("token", "key", "n", "component", "at"), "near-met", free=True)
    forget(shared)
    return leads


def _apart(met: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of classes of different components that may be that similar, of their _leads().

    Sets of n and m shingles need s (n + m) / (1 + s) common ones, c; their first common shingle in any order stands among
    the first n - c + 1 of the one and m - c + 1 of the other. At a shingle the members of its largest component, which
    may be many near copies, meet the others only, not each other.
    """
    main = met.groupBy("token", "component").agg(F.count("*").alias("members")).groupBy("token").agg(F.max(F.struct("members", "component"))["component"].alias("main"))
    rest = met.join(main, "token").where("component <> main").drop("main")
    x, y = (t.select("token", *(F.col(c).alias(f"{s}_{c}") for c in ("key", "n", "component", "at"))) for s, t in (("x", rest), ("y", met)))
    common = F.ceil((F.col("x_n") + F.col("y_n")) * (similarity / (1 + similarity)) - 1e-9)
    fits = (F.least("x_n", "y_n") >= similarity * F.greatest("x_n", "y_n") - 1e-9) & (F.col("x_at") <= F.col("x_n") - common) & (F.col("y_at") <= F.col("y_n") - common)
    pairs = x.join(y, "token").where((F.col("x_component") != F.col("y_component")) & fits)
    return pairs.select(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b")).distinct()


def _candidates(classes: DataFrame, first: int, last: int, more: int, similarity: float) -> DataFrame:
    """(a, b): pairs of classes that follow each other at an anchor, of different components and like sizes."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bits = np.unpackbits(np.frombuffer(b"".join(part.column("bits").to_pylist()), np.uint8).reshape(part.num_rows, -1), axis=1)
                slot = slots(bits, first, last, more)
                each = [pa.array(np.repeat(np.asarray(part.column(c)), slot.shape[1])) for c in ("key", "component")]
                yield pa.RecordBatch.from_arrays([pa.array(slot.ravel()), *each], names=["slot", "key", "component"])

    placed = classes.select("key", "component", "bits").mapInArrow(place, "slot long, key long, component long")
    # the order differs from slot to slot, so that not the same classes follow each other everywhere
    order = Window.partitionBy("slot").orderBy(F.xxhash64("component", "slot"), "key")
    pairs = placed.select("key", "component", *(F.lag(c).over(order).alias(f"last_{c}") for c in ("key", "component"))).where("component <> last_component")
    pairs = pairs.select(F.least("key", "last_key").alias("a"), F.greatest("key", "last_key").alias("b")).distinct()
    sizes = classes.select("key", "n")
    sized = pairs.join(sizes.select(F.col("key").alias("a"), F.col("n").alias("n")), "a").join(sizes.select(F.col("key").alias("b"), F.col("n").alias("m")), "b")
    return sized.where(F.least("n", "m") >= similarity * F.greatest("n", "m")).select("a", "b")


def _links(pairs: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are that similar."""
    pairs = saved(pairs, "near-pairs", free=True)
    both = pairs.join(classes.select(F.col("key").alias("a"), F.col("text").alias("x")), "a").join(classes.select(F.col("key").alias("b"), F.col("text").alias("y")), "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            same = [alike(np.unique(shingle_hashes(x, words)), np.unique(shingle_hashes(y, words)), similarity) for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield batch.loc[np.array(same, bool), ["a", "b"]]

    return both.select("a", "b", "x", "y").mapInPandas(compare, "a long, b long")


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
