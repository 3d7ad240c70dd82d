"""Removal of repeated byte strings by column-wise multi-document suffix sorting.

A collection's Burrows-Wheeler transform grows by one symbol of each of its documents a round, from their ends: the
transform tells where each document's next longer suffix goes, and the new symbols are merged into it in one pass.
The pass reads the transform from front to end and writes it anew; as every collection here is bounded, those files
are in memory. In the finished order two suffixes that share WIDTH bytes are neighbours or have only such between
them, so that comparing neighbours over WIDTH bytes gives the classes of equal strings.

Whole documents would take as many rounds as the longest has bytes. So the collections are made of short documents:
each string of WIDTH bytes belongs to the least GRAM-byte piece in it (its anchor), and the strings that share an
anchor lie in one piece of text of fewer than 2 * WIDTH bytes. Equal strings have equal anchors, so pieces are dealt
by their anchor, and only those whose anchor occurs twice are dealt at all. Equal pieces are one document of the
collection; pieces of an anchor that has no other piece need no sorting. An anchor above HOT pieces has its strings
dealt one by one, each by its own bytes, so that no bucket holds a common passage's many surroundings.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.llm.common import saved, total_bytes
from ferrule.llm.ctw import packed, unpacked

WIDTH, GRAM = 100, 40
CHUNK_BYTES, BATCH_BYTES = 4_000_000, 2_000_000
LEAST_BUCKETS = 16
#: Bytes of text whose anchors are found together, few enough for a processor's cache; their places take the low
#: _INDEX_BITS of a number.
SECTION = 1 << 16
HOT = 20_000
#: Bytes of the pieces that one transform holds, about.
COLLECTION_BYTES = 400_000
#: Ends a document in a transform; no byte of UTF-8.
DONE = 255
#: Bytes of the transform whose symbols are counted together: a block has BLOCK of them when the blocks are laid out, and
#: they are laid out anew before one has more than WIDEST, as many as a byte can number.
BLOCK, WIDEST = 192, 255

_INDEX_BITS = 28
_ROOT = 0x9E3779B97F4A7C15 | 1
_BYTES = np.array([xxhash.xxh64_intdigest(bytes((i,)), 7) for i in range(256)], np.uint64)


def bwt(texts: list[bytes]) -> np.ndarray:
    """The transform of a collection whose documents end in terminators ordered like the documents."""
    n = len(texts)
    lengths = np.fromiter(map(len, texts), np.int64, n)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    used = np.flatnonzero(np.bincount(flat, minlength=256))
    done = len(used)  # symbols are numbered in order, the end of a document above them
    number = np.full(256, done, np.uint8)
    number[used] = np.arange(done)
    flat = number[flat]
    width = done + 1
    ends = np.cumsum(lengths)
    out = np.where(lengths > 0, flat[np.maximum(ends - 1, 0)] if len(flat) else 0, done).astype(np.uint8)
    place, left, doc = np.arange(n), lengths.copy(), np.arange(n)
    first = ends - lengths
    columns = np.arange(WIDEST + 1, dtype=np.uint8)
    starts = counts = None
    while True:
        symbol = out[place]
        go = np.flatnonzero(symbol != done)
        if not len(go):
            return np.append(used, DONE).astype(np.uint8)[out]
        place, left, doc, symbol = place[go], left[go] - 1, doc[go], symbol[go]
        if starts is None or np.diff(np.append(starts, len(out))).max() > WIDEST:
            starts = np.arange(0, len(out), BLOCK)
            padded = np.full(len(starts) * BLOCK, done, np.uint8)
            padded[: len(out)] = out
            counts = np.bincount(np.repeat(np.arange(len(starts)) * width, BLOCK) + padded, minlength=len(starts) * width).reshape(-1, width).astype(np.int32)
            counts[-1, done] -= len(padded) - len(out)
        # how often each symbol occurs before its place: in the blocks before, then within the block
        before = np.cumsum(counts, axis=0, dtype=np.int32)
        total = before[-1].astype(np.int64)
        block = np.searchsorted(starts, place, "right") - 1
        rank = (before[block, symbol] - counts[block, symbol]).astype(np.int64)
        within = (place - starts[block]).astype(np.uint8)
        windows = np.lib.stride_tricks.sliding_window_view(np.append(out, np.full(WIDEST, done, np.uint8)), WIDEST + 1)
        for at in range(0, len(place), 8192):
            part = slice(at, at + 8192)
            hit = (windows[starts[block[part]]] == symbol[part, None]) & (columns < within[part, None])
            # eight counters of a byte in each word; fewer than 256 hits in all
            rank[part] += (hit.view(np.uint64).sum(axis=1) * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int64)
        to = n + (np.cumsum(total) - total)[symbol] + rank
        new = np.where(left > 0, flat[np.maximum(first[doc] + left - 1, 0)], done).astype(np.uint8)
        grown = np.empty(len(out) + len(to), np.uint8)
        old = np.ones(len(grown), bool)
        old[to] = False
        grown[old] = out
        grown[to] = new
        # a new symbol belongs to the block of the old one before it
        order = np.argsort(to, kind="stable")
        behind = to[order] - np.arange(len(to))  # how many old symbols are before it
        home = np.maximum(np.searchsorted(starts, behind, "left") - 1, 0)
        np.add.at(counts, (home, new[order]), 1)
        starts = starts + np.concatenate(([0], np.cumsum(np.bincount(home, minlength=len(starts)))[:-1]))
        out, place = grown, to


def suffix_order(transform: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and start of every suffix in order, by walking back from each document's end."""
    n = len(lengths)
    kept = np.flatnonzero(transform != DONE)
    back = np.full(len(transform), -1)
    back[kept[np.argsort(transform[kept], kind="stable")]] = n + np.arange(len(kept))
    doc, start = np.empty(len(transform), np.int64), np.empty(len(transform), np.int64)
    place, own, at = np.arange(n), np.arange(n), lengths.copy()
    while len(place):
        doc[place], start[place] = own, at
        place = back[place]
        go = place >= 0
        place, own, at = place[go], own[go], at[go] - 1
    return doc, start


def classes(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and class of every string of `width` bytes; equal strings have one class."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    doc, start = suffix_order(bwt(texts), lengths)
    long = lengths[doc] - start >= width
    doc, start = doc[long], start[long]
    flat = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
    words = np.lib.stride_tricks.as_strided(flat, (len(flat) - 7, 8), (1, 1))
    at = (np.cumsum(lengths) - lengths)[doc] + start
    same = np.ones(max(0, len(at) - 1), bool)
    for step in [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]:
        live = np.flatnonzero(same)
        if not len(live):
            break
        value = words[at[live] + step].view(np.uint64).ravel() == words[at[live + 1] + step].view(np.uint64).ravel()
        same[live[~value]] = False
    return doc, start, np.cumsum(np.concatenate((np.zeros(min(1, len(at)), np.int64), ~same)))


@dataclass
class Anchors:
    """The anchors of concatenated texts: place and hash, first and last start of the strings that belong to each."""

    hashes: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors(flat: np.ndarray, lengths: np.ndarray, width: int = WIDTH, gram: int = GRAM, section: int = SECTION) -> Anchors:
    """The anchors of concatenated texts of these lengths; strings that start in one section are dealt with together."""
    ends = np.cumsum(lengths)
    edge = np.zeros(len(flat) + 1, np.int8)
    long = lengths >= width
    np.add.at(edge, (ends - lengths)[long], 1)
    np.add.at(edge, ends[long] - width + 1, -1)
    valid = np.cumsum(edge[:-1], dtype=np.int8) > 0
    found = [_anchors(flat[at : at + section + width - 1], valid[at : at + section], at, width, gram) for at in range(0, max(1, len(flat)), section)]
    return Anchors(*(np.concatenate([getattr(x, c) for x in found]) for c in ("hashes", "first", "last")))


@functools.lru_cache(8)
def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _ROOT, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers, out=powers)


def _anchors(flat: np.ndarray, valid: np.ndarray, offset: int, width: int, gram: int) -> Anchors:
    none = np.zeros(0, np.int64)
    if len(flat) < width or not valid.any():
        return Anchors(np.zeros(0, np.uint64), none, none)
    n = len(flat) - gram + 1
    powers = _powers(len(flat))
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_BYTES[flat] * powers[::-1], out=total[1:])
    # each gram's sum, brought to one power, the same for any number of texts
    hashes = (total[gram:] - total[:n]) * powers[:n] * np.uint64(pow(_ROOT, -(len(flat) - 1), 1 << 64))
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    least = (hashes >> np.uint64(_INDEX_BITS) << np.uint64(_INDEX_BITS)) | np.arange(n, dtype=np.uint64)
    reach, covered = width - gram + 1, 1
    while covered < reach:
        step = min(covered, reach - covered)
        least = np.minimum(least[: len(least) - step], least[step:])
        covered += step
    own = (least & np.uint64((1 << _INDEX_BITS) - 1)).astype(np.int64)
    starts = np.flatnonzero(valid[: len(own)])
    own = own[starts]
    turn = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1))))
    return Anchors(hashes[own[turn]], starts[turn] + offset, starts[np.append(turn[1:], len(own)) - 1] + offset)


class Batch:
    """Some texts of a chunk, in order of their documents, and their anchors."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], bases: np.ndarray | None = None):
        self.ids, self.texts = ids, texts
        self.bases = np.zeros(len(texts), np.int64) if bases is None else bases
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.data = b"".join(texts)
        self.anchors = anchors(np.frombuffer(self.data, np.uint8), self.lengths)


def batches(frame: pd.DataFrame) -> Iterator[Batch]:
    ids, texts = frame["place"].to_numpy(np.int64), [(t or "").encode("utf-8", "surrogatepass") for t in frame["text"]]
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))  # rows that share a place stand in the order of their texts
    ids, texts = ids[order], [texts[i] for i in order]
    bases = np.zeros(len(texts), np.int64)  # such rows are one document: a row begins where the one before it ends
    for i in range(1, len(texts)):
        if ids[i] == ids[i - 1]:
            bases[i] = bases[i - 1] + len(texts[i - 1])
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_BYTES):
            size += len(texts[end])
            end += 1
        yield Batch(ids[at:end], texts[at:end], bases[at:end])
        at = end


def asked(frame: pd.DataFrame, buckets: int) -> Iterator[dict]:
    """The chunk's anchors with their counts, by bucket."""
    keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *(b.anchors.hashes for b in batches(frame))]), return_counts=True)
    for b, own in _by_bucket(keys % np.uint64(buckets)):
        yield {"bucket": b, "keys": packed(keys[own]), "counts": packed(counts[own].astype(np.uint32))}


def _by_bucket(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(of, kind="stable")
    found, at = np.unique(of[order], return_index=True)
    return zip(found.tolist(), np.split(order, at[1:]), strict=True) if len(of) else iter(())


def repeated(frame: pd.DataFrame, hot: int = HOT) -> pd.DataFrame:
    """For each chunk and bucket: 0, 1 or 2 for each of its anchors: once, more often, more than hot times."""
    each = [unpacked(b, np.uint64) for b in frame["keys"]]
    keys, inverse = np.unique(np.concatenate(each), return_inverse=True)
    counts = np.bincount(inverse, weights=np.concatenate([unpacked(b, np.uint32) for b in frame["counts"]]))
    state = (counts > 1).astype(np.uint8) + (counts > hot)
    ends = np.cumsum([len(k) for k in each])
    return pd.DataFrame({"chunk": frame["chunk"], "bucket": frame["bucket"], "kind": "a", "answer": [packed(state[inverse[e - len(k) : e]].astype(np.uint8)) for k, e in zip(each, ends, strict=True)]})


def states(frame: pd.DataFrame, answers: pd.DataFrame, buckets: int) -> list[tuple[Batch, np.ndarray]]:
    """The chunk's batches with their anchors' states."""
    own = list(batches(frame))
    keys = np.sort(np.concatenate([np.zeros(0, np.uint64), *(b.anchors.hashes for b in own)]))
    keys = keys[np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]))]
    got = answers[answers["kind"] == "a"].sort_values("bucket")
    values = np.empty(len(keys), np.uint8)
    values[np.argsort(keys % np.uint64(buckets), kind="stable")] = np.concatenate([np.zeros(0, np.uint8), *(unpacked(b, np.uint8) for b in got["answer"])])
    return [(b, values[np.searchsorted(keys, b.anchors.hashes)]) for b in own]


def pieces(found: list[tuple[Batch, np.ndarray]]) -> Iterator[tuple[Batch, int, bytes, int]]:
    """Every piece that is dealt: its batch, where it starts in the batch, its bytes and the key of its group."""
    for batch, state in found:
        some = np.flatnonzero(state)
        for key, first, last, s in zip(*(x[some].tolist() for x in (batch.anchors.hashes, batch.anchors.first, batch.anchors.last, state)), strict=True):
            if s == 1:
                yield batch, first, batch.data[first : last + WIDTH], key
            else:
                for p in range(first, last + 1):
                    piece = batch.data[p : p + WIDTH]
                    yield batch, p, piece, xxhash.xxh64_intdigest(piece, 11)


def dealt(frame: pd.DataFrame, answers: pd.DataFrame, buckets: int) -> Iterator[dict]:
    """The chunk's distinct pieces, each with the first place it has in the chunk, by bucket."""
    seen: set[bytes] = set()
    out: dict[int, list[tuple]] = {}
    found = states(frame, answers, buckets)
    for batch, at, piece, key in pieces(found):
        if piece not in seen:
            seen.add(piece)
            d = int(np.searchsorted(batch.offsets, at, "right")) - 1  # of texts that start there the last: the others are empty
            out.setdefault(key % buckets, []).append((key, int(batch.ids[d]), at - int(batch.offsets[d]) + int(batch.bases[d]), piece))
    for b, rows in out.items():
        keys, ids, starts, texts = zip(*rows, strict=True)
        yield {"bucket": b, "keys": packed(np.array(keys, np.uint64)), "ids": packed(np.array(ids, np.int64)), "starts": packed(np.array(starts, np.int64)), "lengths": packed(np.fromiter(map(len, texts), np.uint16, len(texts))), "data": packed(np.frombuffer(b"".join(texts), np.uint8))}


def collections(pieces_: np.ndarray, keys: np.ndarray, lengths: np.ndarray, most: int | None = None) -> Iterator[np.ndarray]:
    """Pieces, which stand in the order of their anchors, in collections of about COLLECTION_BYTES; those of one anchor,
    which alone can hold equal strings, stay together. A collection that fits a processor's cache takes far less time a
    byte, as every round passes over all of it."""
    most = COLLECTION_BYTES if most is None else most
    if not len(pieces_):
        return
    key = keys[pieces_]
    opens = np.concatenate(([True], key[1:] != key[:-1]))
    before = np.cumsum(lengths[pieces_]) - lengths[pieces_]
    number = (before[np.flatnonzero(opens)] // most)[np.cumsum(opens) - 1]  # an anchor is where its first piece is
    yield from np.split(pieces_, np.flatnonzero(np.diff(number)) + 1)


def judged(frame: pd.DataFrame) -> pd.DataFrame:
    """For each chunk, a bit for every string of its pieces: whether it also starts earlier than the piece's place."""
    number: dict[bytes, int] = {}
    chunks, keys, ids, starts = [], [], [], []
    for row in frame.itertuples():
        lengths, data = unpacked(row.lengths, np.uint16), unpacked(row.data, np.uint8).tobytes()
        ends = np.cumsum(lengths.astype(np.int64))
        own = np.array([number.setdefault(data[e - n : e], len(number)) for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)], np.int64)
        chunks.append(own)
        keys.append(unpacked(row.keys, np.uint64))
        ids.append(unpacked(row.ids, np.int64))
        starts.append(unpacked(row.starts, np.int64))
    texts = list(number)
    own, key, doc, start = (np.concatenate(x) for x in (chunks, keys, ids, starts))
    order = np.lexsort((start, doc, own))
    head = order[np.flatnonzero(np.concatenate(([True], own[order][1:] != own[order][:-1])))]  # by number: the first place
    first_doc, first_start, first_key = doc[head], start[head], key[head]
    # anchors with more than one piece
    _, group, size = np.unique(first_key, return_inverse=True, return_counts=True)
    sort = np.flatnonzero(size[group] > 1)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = lengths - WIDTH + 1
    at = np.cumsum(counts) - counts
    later = np.zeros(int(counts.sum()), bool)
    for part in collections(sort[np.argsort(first_key[sort], kind="stable")], first_key, lengths):
        piece, offset, kind = classes([texts[i] for i in part.tolist()])
        piece = part[piece]
        d, s = first_doc[piece], first_start[piece] + offset
        by = np.lexsort((s, d, kind))
        opens = np.concatenate(([True], kind[by][1:] != kind[by][:-1]))
        least = by[np.flatnonzero(opens)][np.cumsum(opens) - 1]
        later[(at[piece] + offset)[by]] = (d[by] != d[least]) | (s[by] != s[least])
    rows = []
    for row, mine, ds, ss in zip(frame.itertuples(), chunks, ids, starts, strict=True):
        is_first = (first_doc[mine] == ds) & (first_start[mine] == ss)
        bits = [later[at[i] : at[i] + counts[i]] if f else np.ones(counts[i], bool) for i, f in zip(mine.tolist(), is_first.tolist(), strict=True)]
        rows.append((row.chunk, row.bucket, "p", packed(np.packbits(np.concatenate(bits)))))
    return pd.DataFrame(rows, columns=["chunk", "bucket", "kind", "answer"])


def removed(frame: pd.DataFrame, answers: pd.DataFrame, buckets: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Every text of the chunk in order of place, with the spans (start, end) of bytes to remove."""
    found = states(frame, answers, buckets)
    got = answers[answers["kind"] == "p"]
    bits = {b: np.unpackbits(unpacked(a, np.uint8)) for b, a in zip(got["bucket"], got["answer"], strict=True)}
    used = dict.fromkeys(bits, 0)
    seen: set[bytes] = set()
    marks: dict[int, list[np.ndarray]] = {}
    for batch, at, piece, key in pieces(found):
        count = len(piece) - WIDTH + 1
        if piece in seen:
            marks.setdefault(id(batch), []).append(np.arange(at, at + count))
            continue
        seen.add(piece)
        b = key % buckets
        own = bits[b][used[b] : used[b] + count]
        used[b] += count
        if own.any():
            marks.setdefault(id(batch), []).append(at + np.flatnonzero(own))
    for batch, _ in found:
        cover, n = np.zeros(len(batch.data) + 1, np.int64), len(batch.data) + 1
        if id(batch) in marks:
            starts = np.concatenate(marks[id(batch)])
            cover += np.bincount(starts, minlength=n)
            cover -= np.bincount(starts + WIDTH, minlength=n)
        on = (np.cumsum(cover) > 0).astype(np.int8)
        for i, text in enumerate(batch.texts):
            a = int(batch.offsets[i])
            edge = np.flatnonzero(np.diff(np.concatenate(([0], on[a : a + len(text)], [0]))))
            yield int(batch.ids[i]), text, edge.reshape(-1, 2)


def deduplicated(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, hot: int = HOT) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, spans (removed runs: start and end byte), kept (the remaining bytes).

    Texts shorter than WIDTH bytes, null and empty ones keep all they have; a text of any length is taken whole. A null
    doc_id counts as smaller than any other; ids that aren't whole numbers are ordered by a hash. Rows that share a
    doc_id count one after another in the order of their texts, with places of one document. Other columns are ignored;
    an empty table gives an empty result.
    """
    kind = dict(docs.dtypes)["doc_id"]
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    chunks = max(1, math.ceil(total_bytes(docs) / chunk_bytes))
    buckets = max(LEAST_BUCKETS, chunks // 4)
    place = F.when(F.col("doc_id").isNull(), F.lit(-(1 << 62))).otherwise(F.col("doc_id").cast("long") if whole else F.xxhash64("doc_id"))
    texts = docs.select(place.alias("place"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"))

    def ask(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(asked(frame, buckets)), columns=["bucket", "keys", "counts"]).assign(chunk=key[0])

    def deal(key: tuple, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(dealt(frame, answers, buckets)), columns=["bucket", "keys", "ids", "starts", "lengths", "data"]).assign(chunk=key[0])

    def finish(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for p, text, spans in removed(frame, answers, buckets):
            edges = [0, *spans.ravel().tolist(), len(text)]
            kept = b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
            rows.append((p, len(text), [{"start": a, "end": b} for a, b in spans.tolist()], kept))
        return pd.DataFrame(rows, columns=["place", "n_bytes", "spans", "kept"])

    counts = texts.groupBy("chunk").applyInPandas(ask, "bucket int, keys binary, counts binary, chunk long")
    known = saved(counts.groupBy("bucket").applyInPandas(lambda frame: repeated(frame, hot), "chunk long, bucket int, kind string, answer binary"), "anchors", free=True)
    strings = texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(deal, "bucket int, keys binary, ids binary, starts binary, lengths binary, data binary, chunk long")
    verdicts = saved(strings.groupBy("bucket").applyInPandas(judged, "chunk long, bucket int, kind string, answer binary"), "verdicts", free=True)
    both = known.unionByName(verdicts).groupBy("chunk")
    out = texts.groupBy("chunk").cogroup(both).applyInPandas(finish, "place long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    if whole:
        return out.select(F.when(F.col("place") != -(1 << 62), F.col("place")).cast(kind).alias("doc_id"), "n_bytes", "spans", "kept")
    names = docs.select(place.alias("place"), "doc_id").distinct()
    return out.join(names, "place").select("doc_id", "n_bytes", "spans", "kept")


def query(spark, sf_dir: str) -> DataFrame:
    found = deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
