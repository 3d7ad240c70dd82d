"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

Every byte of a document gets a label: no token ends there, one of A ends there, one of B, or both. A regular expression
scans the string of labels and takes spans up to each both-label; the labels inside a span count the tokens of its group.
The last tokens of a group end together: they are linked.

How often the corpus links a pair of ids is counted chunk by chunk: a chunk of documents asks for each of its pairs once,
and its documents' links are places in the chunk's list of pairs, so that neither a frequent pair nor a vocabulary of any
size meets in one task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ferrule.llm.common import free_name, saved

FOLDER, BYTE_LEVEL, PIECES = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of a tokenizer's file at most: it is broadcast.
MOST_BYTES = 64_000_000
#: Bytes of text that are encoded together, and links that share one list of pairs, about: a document is never cut.
SLICE_BYTES, CHUNK_LINKS = 1_000_000, 1 << 19
#: How a byte-level vocabulary cuts texts.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_LEVEL_STEP = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
LABELS = np.frombuffer(b"-AB*", np.uint8)
SPAN = re.compile(rb"[^*]*\*")
ALIGNMENT = "a_ids array<int>, b_ids array<int>, ends array<int>, a_counts array<int>, b_counts array<int>"
FIELDS = [f.split()[0] for f in ALIGNMENT.split(", ")]


def byte_alphabet() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if it prints, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """The vocabulary of a byte-level .json of the library `tokenizers`; it gets the text with a space in front.

    It runs in `tiktoken`, which takes a third of the time and gives the same ids, as ids stand in the order of merges and
    both cut texts by the same classes of characters (the tests compare all code points and the tables' texts).
    """

    def __init__(self, model: bytes):
        from tiktoken import Encoding

        read = json.loads(model)
        if read["normalizer"] or read["pre_tokenizer"] != BYTE_LEVEL_STEP or [x["content"] for x in read["added_tokens"] if not x["special"]]:
            raise ValueError("only plain byte-level vocabularies are known")
        alphabet, special = byte_alphabet(), {x["content"] for x in read["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in read["model"]["vocab"].items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
        if any(ranks[bytes(alphabet[c] for c in "".join(m))] != 256 + i for i, m in enumerate(merges)):
            raise ValueError("ids don't stand in the order of merges")
        self.inner = Encoding("bytes", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.inner.encode_to_numpy(f" {t}", disallowed_special=()).astype(np.int64) for t in texts]


class Pieces:
    """A tokenizer of the library `sentencepiece` with byte fallback, which puts a space in front by itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.inner = SentencePieceProcessor(model_proto=model)
        pieces = self.inner.id_to_piece(list(range(self.inner.get_piece_size())))
        self.tokens = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.inner.encode(texts, num_threads=1)]


KINDS = {".json": ByteLevel, ".model": Pieces}
#: A worker process keeps the tokenizers it has loaded.
_loaded: dict[str, tuple] = {}


def _tokenizer(sent: Broadcast):
    suffix, digest, model = sent.value
    if digest not in _loaded:
        made = KINDS[suffix](model)
        _loaded[digest] = made, np.array([len(t) for t in made.tokens], np.int64)
    return _loaded[digest]


def send(spark: SparkSession, path: str) -> Broadcast:
    """The file of a tokenizer (.json of `tokenizers`, .model of `sentencepiece`), read by the driver, for all executors."""
    model = Path(path).read_bytes()
    if len(model) > MOST_BYTES:
        raise ValueError(f"{path} has {len(model)} bytes; at most {MOST_BYTES} are sent to every executor")
    return spark.sparkContext.broadcast((Path(path).suffix, hashlib.sha256(model).hexdigest(), model))


def label_string(ends_a: np.ndarray, ends_b: np.ndarray, size: int) -> np.ndarray:
    """0 to 3 for every byte: bit 0 where a token of A ends, bit 1 where one of B does."""
    found = np.zeros(size, np.uint8)
    found[ends_a - 1] |= 1
    found[ends_b - 1] |= 2
    return found


@dataclass
class Aligned:
    """Columns of lists, one list a document: flat values, and offsets of the lists."""

    values: dict[str, np.ndarray]
    offsets: dict[str, np.ndarray]

    def array(self) -> pa.StructArray:
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(self.offsets[f], pa.int32()), pa.array(self.values[f], pa.int32())) for f in FIELDS], FIELDS)


def align(texts: list[str | None], a, b) -> Aligned:
    """a, b: a tokenizer and the lengths of its tokens."""
    (tok_a, len_a), (tok_b, len_b) = a, b
    plain = [t or "" for t in texts]
    ids_a, ids_b = tok_a.encode(plain), tok_b.encode(plain)
    sizes, none = np.zeros(len(texts), np.int64), np.zeros(0, np.int64)
    for i, t in enumerate(plain):
        whole = f" {t}".encode() if t else b""
        if t and b"".join(map(tok_a.tokens.__getitem__, ids_a[i].tolist())) == whole == b"".join(map(tok_b.tokens.__getitem__, ids_b[i].tolist())):
            sizes[i] = len(whole)
        else:
            ids_a[i] = ids_b[i] = none
    flat_a, flat_b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
    stops = np.cumsum(sizes)
    found = label_string(np.cumsum(len_a[flat_a]), np.cumsum(len_b[flat_b]), int(sizes.sum()))
    ends = np.cumsum(np.fromiter(map(len, SPAN.findall(LABELS[found].tobytes())), np.int64))
    counts = [np.diff(np.cumsum((found >> k) & 1, dtype=np.int64)[ends - 1], prepend=0) for k in (0, 1)]
    groups = np.concatenate([[0], np.searchsorted(ends, stops, "right")])
    starts = np.repeat(stops - sizes, np.diff(groups))
    offsets = {f: np.concatenate([[0], np.cumsum([*map(len, ids)])]).astype(np.int64) for f, ids in (("a_ids", ids_a), ("b_ids", ids_b))}
    return Aligned({"a_ids": flat_a, "b_ids": flat_b, "ends": ends - starts, "a_counts": counts[0], "b_counts": counts[1]}, offsets | dict.fromkeys(FIELDS[2:], groups))


def _slices(batches: Iterator[pa.RecordBatch], place: int, a: Broadcast, b: Broadcast) -> Iterator[tuple[list[pa.Array], Aligned]]:
    """The other columns of SLICE_BYTES of texts at a time, and their alignment."""
    both = _tokenizer(a), _tokenizer(b)
    for batch in batches:
        sizes, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
            part = batch.slice(at, to - at)
            yield [c for i, c in enumerate(part.columns) if i != place], align(part.column(place).to_pylist(), *both)
            at = to


def _others(docs: DataFrame, text: str) -> tuple[int, list[StructField]]:
    place = [c.lower() for c in docs.columns].index(text.lower())
    return place, [f for i, f in enumerate(docs.schema.fields) if i != place]


def alignments(docs: DataFrame, a: Broadcast, b: Broadcast, text: str = "text", name: str = "alignment") -> DataFrame:
    """docs with a column `name` (ALIGNMENT) in the place of `text`: the ids of either tokenizer, the byte offset in
    space+text at which each group ends, and how many tokens of either it has.

    Null and empty texts, and those whose tokens don't give back space+text, have empty lists. A text of any length is
    encoded whole; repeated rows are rows of their own; other columns pass through whatever their names. No rows give no
    rows.
    """
    name = free_name(docs.columns, name)
    place, kept = _others(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, found in _slices(batches, place, a, b):
            yield pa.RecordBatch.from_arrays([*own, found.array()], names=[*(f.name for f in kept), name])

    return docs.mapInArrow(run, StructType([*kept, StructField(name, StructType.fromDDL(ALIGNMENT))]))


def group_texts(columns: dict[str, np.ndarray], groups: np.ndarray) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of each document; groups: offsets of the documents' groups."""
    to_a, to_b = np.cumsum(columns["a_counts"]), np.cumsum(columns["b_counts"])
    parts = np.empty(len(columns["a_ids"]) + len(columns["b_ids"]), object)
    for ids, counts, to, other, mark in (("a_ids", "a_counts", to_a, np.concatenate([[0], to_b[:-1]]), "|"), ("b_ids", "b_counts", to_b, to_a, ";")):
        if len(to):
            marked, own = columns[ids] * 2, np.arange(len(columns[ids]))
            marked[to - 1] += 1
            own += np.repeat(other, columns[counts])
            parts[own] = _marked(mark, 1 << int(columns[ids].max()).bit_length())[marked]
    cuts = np.concatenate([[0], to_a + to_b])[groups].tolist()
    return ["".join(parts[i:j].tolist())[:-1] for i, j in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=8)
def _marked(mark: str, ids: int) -> np.ndarray:
    """At 2i the id i with a comma behind it, at 2i + 1 with the mark."""
    return np.array([f"{i}{end}" for i in range(ids) for end in (",", mark)], object)


DIGEST = "chunk long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, pairs array<long>, times array<long>"


def digested(docs: DataFrame, a: Broadcast, b: Broadcast, text: str = "text", chunk_links: int | None = None) -> DataFrame:
    """What alignments() finds, as counts and a digest, and the links of each document, in chunks of rows.

    links: places in the chunk's list of pairs, 32 bits each. The list stands at the first row of the chunk: pairs
    (A id << 32 | B id) and how many links of the chunk hold each. Columns of docs with a name of DIGEST are left out.
    """
    added = StructType.fromDDL(DIGEST)
    docs = docs.select(*(c for c in docs.columns if c.lower() not in added.names or c.lower() == text.lower()))
    place, kept = _others(docs, text)
    chunk_links = chunk_links or CHUNK_LINKS

    def chunk_of(held: list[tuple[list[pa.Array], Aligned]], number: int) -> pa.RecordBatch:
        columns = {f: np.concatenate([x.values[f] for _, x in held]) for f in FIELDS}
        n_a, n_b, n_groups = (np.concatenate([np.diff(x.offsets[f]) for _, x in held]) for f in ("a_ids", "b_ids", "ends"))
        groups, n = np.concatenate([[0], np.cumsum(n_groups)]), len(n_groups)
        to_a, to_b = np.cumsum(columns["a_counts"]), np.cumsum(columns["b_counts"])
        pairs, links, times = np.unique(columns["a_ids"][to_a - 1] << 32 | columns["b_ids"][to_b - 1], return_inverse=True, return_counts=True)
        links, cuts = links.astype("<u4"), groups.tolist()
        digests = [hashlib.sha256(t.encode()).hexdigest() if g else "" for t, g in zip(group_texts(columns, groups), n_groups.tolist(), strict=True)]
        new = [np.full(n, number), n_a, n_b, n_groups, digests, [links[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)], [pairs, *[None] * (n - 1)], [times, *[None] * (n - 1)]]
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        own = [pa.concat_arrays(list(c)) for c in zip(*(own for own, _ in held), strict=True)]
        return pa.RecordBatch.from_arrays([*own, *(pa.array(c, k) for c, k in zip(new, kinds, strict=True))], names=[*(f.name for f in kept), *added.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, links, number = [], 0, TaskContext.get().partitionId() << 32
        for own, found in _slices(batches, place, a, b):
            held.append((own, found))
            links += len(found.values["ends"])
            if links >= chunk_links:
                yield chunk_of(held, number)
                held, links, number = [], 0, number + 1
        if held:
            yield chunk_of(held, number)

    return docs.mapInArrow(run, StructType([*kept, *added.fields]))


def pair_counts(digests: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus hold a pair of ids, and whether no other pair of its B id has
    more."""
    counts = digests.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(digests: DataFrame) -> DataFrame:
    """digests (materialised) with n_links, n_best and count_sum in the place of chunk, links, pairs and times.

    A chunk with as many as CHUNK_LINKS links and its answers meet in one call; a pair is asked once by a chunk, and the
    adaptive planner splits the asks of a frequent one.
    """
    asked = digests.where(F.col("pairs").isNotNull()).select(F.col("chunk").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(digests), "pair").select("of", "place", "count", "best")
    rows = digests.drop("pairs", "times")
    own = [f for f in rows.schema.fields if f.name not in ("chunk", "links")]
    added = StructType.fromDDL("n_links long, n_best long, count_sum long")

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        counts, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right.column("place").to_numpy()
        counts[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy()
        links = [np.frombuffer(x.as_buffer(), "<u4") for x in left.column("links")]
        new = [[len(x) for x in links], [int(best[x].sum()) for x in links], [int(counts[x].sum()) for x in links]]
        return pa.table([*(left.column(f.name) for f in own), *(pa.array(c, pa.int64()) for c in new)], names=[*(f.name for f in own), *added.names])

    return rows.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(answered, StructType([*own, *added.fields]))


def query(spark: SparkSession, sf_dir: str, folder: str = FOLDER) -> DataFrame:
    """Every document's groups, as counts and a digest, and its links; ids as they are, null and repeated ones too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    digests = digested(docs, send(spark, f"{folder}/{BYTE_LEVEL}"), send(spark, f"{folder}/{PIECES}"))
    return scored(saved(digests, "alignment-chunks")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
