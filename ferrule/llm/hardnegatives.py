"""Hard negatives by vantage-point trees over norm-augmented vectors.

A vector x gets one more component, sqrt(M - |x|^2) with M the largest squared norm of all, and a query q gets zero
there: the squared distance is |q|^2 + M - 2 qx, so that a window of inner products is an annulus of distances around q.

The index is a forest. A tree fitted on a bounded sample (SAMPLE_PER_LEAF rows for each of at most LEAVES leaves) routes
every row to a leaf; a leaf's rows are dealt into pieces of about PIECE_ROWS rows, however many equal vectors it holds,
and each piece has a tree of its own, fitted on all its rows. Bounds of distances to the vantage points above are exact
for leaves and buckets, so that nothing is lost: results equal brute force.

A search runs in two rounds. Each query first looks into one piece of the leaf nearest within its annulus; the k-th score
found there then tells which other pieces can hold better rows. Inside a piece the buckets of the annulus are taken
nearest first, until the next one can't reach the k-th score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.llm.common import forget, saved

LEAVES, SAMPLE_PER_LEAF, PIECE_ROWS, BUCKET_ROWS, ASK_BLOCK = 256, 64, 4096, 128, 512
POSITIVES, NEGATIVES, SCALE = 5, 10, 256
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53
#: Scores that no row has.
BELOW, ABOVE = -(1 << 62), 1 << 62


def distances(dots: np.ndarray, squares: np.ndarray | float) -> np.ndarray:
    return np.sqrt(np.maximum(squares - 2 * dots, 0))


def augmented(vectors: np.ndarray, most: int) -> np.ndarray:
    """The vectors with the component that gives all of them the squared norm `most`."""
    rest = most - np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0))]).astype(float)


@dataclass
class Tree:
    """A complete tree: node i has the children 2i + 1 and 2i + 2. lo, hi: of each leaf's distances to the vantage point
    of each level above it; a leaf without rows has lo above hi."""

    points: np.ndarray
    middle: np.ndarray
    depth: int
    lo: np.ndarray
    hi: np.ndarray

    def route(self, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each augmented row and its distances to the vantage points on the way."""
        node, seen = np.zeros(len(rows), np.int64), np.zeros((len(rows), self.depth))
        for level in range(self.depth):
            seen[:, level] = distances(np.einsum("ij,ij->i", rows, self.points[node]), 2.0 * most)
            node = 2 * node + 1 + (seen[:, level] > self.middle[node])
        return node - (2**self.depth - 1), seen

    def scores_within(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each query (not augmented) and leaf: no row of the leaf scores below the first or above the second; a leaf
        that has no rows gets an empty range."""
        squares = np.einsum("ij,ij->i", queries, queries) + float(most)
        near = np.zeros((len(queries), 2**self.depth))
        far = np.full(near.shape, np.sqrt(squares.max(initial=0)) * 2 + 1)
        if self.depth:
            to = distances(queries @ self.points[:, :-1].T, squares[:, None])
            slack = 2e-7 * math.sqrt(most) + 1e-6
            for level in range(self.depth):
                own = to[:, 2**level - 1 + (np.arange(2**self.depth) >> (self.depth - level))]
                near = np.maximum(near, np.maximum(own - self.hi[:, level], self.lo[:, level] - own) - slack)
                far = np.minimum(far, own + self.hi[:, level] + slack)
        room = 1e-9 * most + 1e-6
        high, low = (squares[:, None] - near**2) / 2 + room, (squares[:, None] - far**2) / 2 - room
        return np.where(np.isneginf(self.hi[:, :1].T), np.inf, low) if self.depth else low, np.where(np.isneginf(self.hi[:, :1].T), -np.inf, high) if self.depth else high


def fit(sample: np.ndarray, depth: int, most: int) -> Tree:
    """A tree of augmented rows: vantage points far from the one above, split at the median distance."""
    nodes = 2**depth - 1
    points, middle = np.zeros((nodes, sample.shape[1])), np.zeros(nodes)
    held = {0: np.arange(len(sample))}
    for node in range(nodes):
        own = held.pop(node)
        if len(own):
            above = points[(node - 1) // 2] if node else sample[own].mean(axis=0)
            points[node] = sample[own[np.argmax(((sample[own] - above) ** 2).sum(axis=1))]]
            to = distances(sample[own] @ points[node], 2.0 * most)
            middle[node] = np.median(to)
            held[2 * node + 1], held[2 * node + 2] = own[to <= middle[node]], own[to > middle[node]]
        else:
            held[2 * node + 1] = held[2 * node + 2] = own
    return Tree(points, middle, depth, np.zeros((2**depth, depth)), np.zeros((2**depth, depth)))


def piece_tree(vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, Tree]:
    """The order of a piece's rows by buckets, the buckets' cuts, and the tree; halves at each level, so that equal
    vectors are split too."""
    rows = augmented(vectors, most)
    depth = max(0, math.ceil(math.log2(len(rows) / BUCKET_ROWS))) if len(rows) else 0
    order, cuts = np.arange(len(rows)), np.array([0, len(rows)])
    points = np.zeros((2**depth - 1, rows.shape[1]))
    for level in range(depth):
        now = [0]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            node, own = 2**level - 1 + i, order[a:b]
            above = points[(node - 1) // 2] if node else rows[own].mean(axis=0)
            points[node] = rows[own[np.argmax(((rows[own] - above) ** 2).sum(axis=1))]]
            order[a:b] = own[np.argsort(distances(rows[own] @ points[node], 2.0 * most), kind="stable")]
            now += [(a + b) // 2, b]
        cuts = np.array(now)
    tree = Tree(points, np.zeros(len(points)), depth, np.zeros((2**depth, depth)), np.zeros((2**depth, depth)))
    for leaf, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        for level in range(depth):
            to = distances(rows[order[a:b]] @ points[2**level - 1 + (leaf >> (depth - level))], 2.0 * most)
            tree.lo[leaf, level], tree.hi[leaf, level] = to.min(initial=np.inf), to.max(initial=-np.inf)
    return order, cuts, tree


def traverse(vectors, labels, ranks, rows, cuts, tree, most, queries, own_labels, own_rows, of, low, high, floor, same, k):
    """The k best rows of a piece for each window: (window, place in the piece, score).

    queries, own_labels, own_rows: of the asking rows; of: each window's asking row; low, high, floor: its least and
    largest score and the k-th score known. ranks: the order of the piece's rows among equal scores.
    """
    kind = float if most < EXACT else np.int64
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    least, largest = tree.scores_within(queries.astype(float), most)
    least, largest = least[of], np.minimum(largest[of], high[:, None].astype(float))
    need = np.maximum(low, floor).astype(float)
    order = np.argsort(-np.where((least <= high[:, None]) & (largest >= need[:, None]), largest, -np.inf), axis=1, kind="stable")
    largest = np.take_along_axis(np.where(least <= high[:, None], largest, -np.inf), order, axis=1)
    best, place = np.full((len(of), k), BELOW, np.int64), np.full((len(of), k), -1)
    active = np.arange(len(of))
    for step in range(order.shape[1]):
        active = active[largest[active, step] >= np.maximum(need[active], best[active, -1].astype(float))]
        if not len(active):
            break
        for bucket in np.unique(order[active, step]):
            windows = active[order[active, step] == bucket]
            own, asking = np.arange(cuts[bucket], cuts[bucket + 1]), of[windows]
            scores = (queries[asking] @ vectors[own].T).astype(np.int64)
            fits = (labels[own] == own_labels[asking, None]) == same
            fits &= (rows[own] != own_rows[asking, None]) & (scores >= np.maximum(low, floor)[windows, None]) & (scores <= high[windows, None])
            scores = np.concatenate([best[windows], np.where(fits, scores, BELOW)], axis=1)
            places = np.concatenate([place[windows], np.where(fits, own, -1)], axis=1)
            first = np.lexsort((np.where(places < 0, np.iinfo(np.int64).max, ranks[places]), -scores), axis=1)[:, :k]
            best[windows], place[windows] = np.take_along_axis(scores, first, axis=1), np.take_along_axis(places, first, axis=1)
    found, nth = np.nonzero(place >= 0)
    return found, place[found, nth], best[found, nth]


def prepared(vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, vec, norm) of the rows that take part, written: components times `scale` and rounded down.

    Left out: null labels and vectors, and vectors with a null or non-finite component. A vector without components
    scores zero with all; shorter vectors count as filled with zeros. Squared norms must fit a long, else Spark raises.
    """
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    found = vectors.where(F.col("label").isNotNull() & F.col(vector).isNotNull() & whole)
    vec = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    found = found.select(F.monotonically_increasing_id().alias("row"), F.col(id_name).cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("vec"))
    return saved(found.withColumn("norm", F.aggregate("vec", F.lit(0).cast("long"), lambda s, x: s + x * x)), "vectors")


@dataclass
class Index:
    """rows: (row, vec_id, label, vec as bytes); pieces: one row a piece, its tree and rows packed; the tree over
    leaves; pieces of each leaf; largest squared norm."""

    rows: DataFrame
    pieces: DataFrame
    tree: Tree
    numbers: np.ndarray
    most: int


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width)


PIECE = "piece long, rows binary, ids array<long>, labels binary, vecs binary, cuts binary, points binary, lo binary, hi binary"


def build(base: DataFrame, piece_rows: int = PIECE_ROWS, leaves: int = LEAVES) -> Index | None:
    """The index of prepared() rows; nothing for no rows."""
    spark = base.sparkSession
    count, most, width = base.agg(F.count("*"), F.max("norm"), F.max(F.size("vec"))).first()
    if not count:
        return None
    depth = max(0, min(int(math.log2(leaves)), math.ceil(math.log2(count / piece_rows))))
    width = max(width, 1)

    def padded(lists: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(lists), width), np.int64)
        for i, x in enumerate(lists):
            out[i, : len(x)] = x
        return out

    sample = base.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_PER_LEAF * 2**depth).select("vec").toArrow().column("vec").to_pylist() if depth else []
    sent = spark.sparkContext.broadcast(fit(augmented(padded(sample), most), depth, most))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = padded(batch.column("vec").to_pylist())
            leaf, seen = sent.value.route(augmented(vecs, most), most)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "vec_id", "label")), pa.array([v.astype("<i8").tobytes() for v in vecs], pa.binary()), pa.array(leaf), pa.array(list(seen), pa.list_(pa.float64()))], names=["row", "vec_id", "label", "vec", "leaf", "seen"])

    rows = saved(base.select("row", "vec_id", "label", "vec").mapInArrow(routed, "row long, vec_id long, label long, vec binary, leaf long, seen array<double>"), "vector-leaves")
    each = rows.groupBy("leaf").agg(F.count("*").alias("n"), *(f(F.col("seen")[i]).alias(f"{n}{i}") for i in range(depth) for n, f in (("lo", F.min), ("hi", F.max)))).collect()
    tree, numbers = sent.value, np.zeros(2**depth, np.int64)
    tree.lo[:], tree.hi[:] = np.inf, -np.inf
    for r in each:
        numbers[r.leaf] = math.ceil(r.n / piece_rows)
        tree.lo[r.leaf], tree.hi[r.leaf] = [r[f"lo{i}"] for i in range(depth)], [r[f"hi{i}"] for i in range(depth)]
    of_leaf = F.element_at(F.array(*(F.lit(int(max(n, 1))) for n in numbers)), (F.col("leaf") + 1).cast("int"))
    dealt = rows.select("row", "vec_id", "label", "vec", (F.shiftleft("leaf", 32) + F.pmod(F.xxhash64("row"), of_leaf)).alias("piece"))

    def packed(key: tuple, own: pa.Table) -> pa.Table:
        vecs = _matrix(own.column("vec"), width)
        order, cuts, local = piece_tree(vecs, most)
        own = own.take(pa.array(order))
        pack = lambda x, kind="<i8": [np.ascontiguousarray(x).astype(kind).tobytes()]
        values = [[key[0].as_py()], pack(own.column("row").to_numpy()), [own.column("vec_id").to_pylist()], pack(own.column("label").to_numpy()), pack(vecs[order]), pack(cuts), pack(local.points, "<f8"), pack(local.lo, "<f8"), pack(local.hi, "<f8")]
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), *[pa.binary()] * 6]
        return pa.table([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=[f.split()[0] for f in PIECE.split(", ")])

    pieces = saved(dealt.groupBy("piece").applyInArrow(packed, PIECE), "vector-index")
    return Index(rows.select("row", "vec_id", "label", "vec"), pieces, tree, numbers, most)


WINDOWS = "array<struct<w:int,low:long,high:long,floor:long>>"


def _asked(index: Index, asks: DataFrame, same: bool, k: int, rest: bool) -> tuple[DataFrame, DataFrame]:
    """(asker, w, row, vec_id, score) that the asks (row, label, vec, windows) find: each in one piece of the leaf nearest
    within each of its windows, or in all other pieces that can hold something for it. Also the table of visits, to be
    deleted once the first is written."""
    spark, most, numbers = asks.sparkSession, index.most, index.numbers
    top = spark.sparkContext.broadcast(index.tree)
    blocks = max(1, math.ceil(asks.count() / ASK_BLOCK))
    names = ["piece", "asker", "label", "vec", "windows"]
    width = index.tree.points.shape[1] - 1

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ASK_BLOCK):
                batch = whole.slice(at, ASK_BLOCK)
                least, largest = top.value.scores_within(_matrix(batch.column("vec"), width).astype(float), most)
                where, pieces = [], []
                for i, (row, windows) in enumerate(zip(batch.column("row").to_pylist(), batch.column("windows").to_pylist(), strict=True)):
                    open_, probed = np.zeros(len(numbers), bool), set()
                    for x in windows:
                        fits = (numbers > 0) & (least[i] <= x["high"]) & (largest[i] >= x["low"])
                        if fits.any():
                            leaf = int(np.argmax(np.where(fits, np.minimum(largest[i], x["high"]), -np.inf)))
                            probed.add(leaf << 32 | row % int(numbers[leaf]))
                        open_ |= fits & (largest[i] >= x["floor"])
                    found = [p for leaf in np.flatnonzero(open_).tolist() for p in range(leaf << 32, (leaf << 32) + int(numbers[leaf])) if p not in probed] if rest else sorted(probed)
                    pieces += found
                    where += [i] * len(found)
                for a in range(0, len(where), 4 * ASK_BLOCK):
                    part = batch.take(pa.array(where[a : a + 4 * ASK_BLOCK], pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(pieces[a : a + 4 * ASK_BLOCK], pa.int64()), *(part.column(c) for c in ("row", "label", "vec", "windows"))], names=names)

    asked = asks.select("row", "label", "vec", "windows").mapInArrow(visits, f"piece long, asker long, label long, vec binary, windows {WINDOWS}")
    asked = saved(asked.withColumn("block", F.pmod(F.xxhash64("asker"), F.lit(blocks)).cast("int")), "vector-asks")
    copies = index.pieces.join(asked.select(F.col("piece").alias("at"), F.col("block").alias("part")).distinct(), F.col("piece") == F.col("at")).drop("at")

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"asker": [], "w": [], "row": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            read = lambda c, kind="<i8": np.frombuffer(right.column(c)[0].as_buffer(), kind)
            ids, rows, cuts = right.column("ids")[0].as_py(), read("rows"), read("cuts")
            vectors = read("vecs").reshape(len(rows), -1)
            depth = int(math.log2(len(cuts) - 1))
            local = Tree(read("points", "<f8").reshape(2**depth - 1, vectors.shape[1] + 1), np.zeros(0), depth, *(read(c, "<f8").reshape(2**depth, depth) for c in ("lo", "hi")))
            ranks = np.empty(len(rows), np.int64)
            ranks[sorted(range(len(rows)), key=lambda i: (ids[i] is None, ids[i] or 0, rows[i]))] = np.arange(len(rows))
            windows = [(i, x["w"], x["low"], x["high"], x["floor"]) for i, own in enumerate(left.column("windows").to_pylist()) for x in own]
            of, w, low, high, floor = (np.array(c, np.int64) for c in zip(*windows, strict=True))
            askers = left.column("asker").to_numpy()
            found, place, score = traverse(vectors, read("labels"), ranks, rows, cuts, local, most, _matrix(left.column("vec"), vectors.shape[1]), left.column("label").to_numpy(), askers, of, low, high, floor, same, k)
            out = {"asker": askers[of[found]], "w": w[found], "row": rows[place], "vec_id": [ids[i] for i in place.tolist()], "score": score}
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=[*out])

    found = asked.groupBy("piece", "block").cogroup(copies.groupBy("piece", "part")).applyInArrow(answered, "asker long, w int, row long, vec_id long, score long")
    return found, asked


def search(index: Index, asks: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
    """(asker, w, rank, row, vec_id, score): the k best rows of the index for every window (row, w, low, high) of the asks
    (row, label, vec), of the asking row's label or, unless `same`, of another; never the asking row itself.

    Ties go by vec_id, null last, then by row. Exact: leaves and buckets go by bounds only.
    """

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("asker", "w").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def with_windows(own: DataFrame) -> DataFrame:
        lists = own.groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct(F.col("w").cast("int").alias("w"), "low", "high", "floor")).alias("windows"))
        return asks.join(lists, F.col("row") == F.col("r")).drop("r")

    def round_of(own: DataFrame, rest: bool, more: DataFrame | None = None) -> DataFrame:
        lists = saved(with_windows(own), "vector-windows")
        found, visits = _asked(index, lists, same, k, rest)
        out = saved(best(found if more is None else more.drop("rank").union(found)), "vector-found")
        for used in (lists, visits, more):
            if used is not None:
                forget(used)
        return out

    first = round_of(windows.withColumn("floor", F.lit(BELOW)), False)
    known = first.where(F.col("rank") == k).select(F.col("asker").alias("row"), "w", F.col("score").alias("floor"))
    return round_of(windows.join(known, ["row", "w"], "left").withColumn("floor", F.coalesce("floor", F.lit(BELOW))), True, first)


def mined(vectors: DataFrame, anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = 30, most: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    vectors: vec_id, embedding, label; other columns are ignored. Anchors are rows whose vec_id `anchor_every` divides,
    their positives the best other rows of their label; negatives are the best rows of other labels that score at least
    `least` and at most `most` hundredths of the positive. A repeated vec_id is a row of its own; a null one is no
    anchor, and last among ties. A positive with a negative score, or without fitting rows, gives none.
    """
    spark = vectors.sparkSession
    index = build(prepared(vectors))
    if index is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    asks = saved(index.rows.where(F.col("vec_id") % anchor_every == 0), "anchors")
    every = asks.select("row", F.lit(0).alias("w"), F.lit(BELOW).alias("low"), F.lit(ABOVE).alias("high"))
    found = search(index, asks, every, True, positives).select(F.col("asker").alias("row"), F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = found.where("positive_score >= 0").select("row", "w", F.expr(f"({least} * cast(positive_score as decimal(38,0)) + 99) div 100").alias("low"), F.expr(f"{most} * cast(positive_score as decimal(38,0)) div 100").alias("high"))
    rows = search(index, asks, windows, False, negatives).withColumnRenamed("row", "found").withColumnRenamed("asker", "row")
    ids = asks.select("row", F.col("vec_id").alias("anchor_id"))
    return rows.join(found, ["row", "w"]).join(ids, "row").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the embeddings, with the labels of every seventh moved on by one; see mined()."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mined(vectors.withColumn("label", moved))


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.vec, b.vec)::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
