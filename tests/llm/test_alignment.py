"""Alignment of two tokenizers against a plain version over single documents."""

import hashlib
import os
from collections import Counter
from functools import cache

import numpy as np
import pytest

from ferrule.llm import alignment

pytestmark = pytest.mark.skipif(not os.path.isdir(alignment.FOLDER), reason="no tokenizers")


@cache
def byte_level():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.BYTE_LEVEL}")
    found.encode_special_tokens = True
    return found


def plain_tokens(text):
    """(id, end) of either tokenizer, A by the library its file is of; nothing if the bytes differ."""
    import public_tokenizers as P
    import sentencepiece

    alphabet = alignment.byte_alphabet()
    second = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    if not text:
        return [], []
    whole = (" " + text).encode()
    a = [(i, bytes(alphabet[c] for c in byte_level().id_to_token(i))) for i in byte_level().encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    ended = []
    for tokens in (a, b):
        at, out = 0, []
        for i, x in tokens:
            at += len(x)
            out.append((i, at))
        ended.append(out)
    return tuple(ended)


def plain(rows):
    """rows of (doc_id, text) to what the query returns."""
    tokens = [(i, *plain_tokens(t)) for i, t in rows]
    links = [[(x, y) for x, e in a for y, f in b if e == f] for _, a, b in tokens]
    counts = Counter(x for own in links for x in own)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (i, a, b), own in zip(tokens, links, strict=True):
        cuts = sorted({e for _, e in a} & {f for _, f in b})
        groups, last = [], 0
        for c in cuts:
            groups.append(",".join(str(x) for x, e in a if last < e <= c) + "|" + ",".join(str(y) for y, f in b if last < f <= c))
            last = c
        text = ";".join(groups)
        out.append((i, len(a), len(b), len(cuts), len(own), sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


TEXTS = [
    "The quick brown fox, jumping over 1234 lazy dogs!", "The quick brown fox", "", None, "a", " leading and  double spaces ", "äöü ß straße — “quoted”", "\n\n\ttabs\r\nlines\n", "emoji \U0001f600\U0001f468‍\U0001f469 here",
    "<|endoftext|> and <s> and </s> are text", "under▁score is no space", "\x00 nul <0x41> and \x7f", "日本語のテキスト", "é ﬁ", "The quick brown fox, jumping over 1234 lazy dogs!", "word " * 3000, "x" * 5000,
]


def run(spark, rows, links=1000):
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    sent = [alignment.send(spark, f"{alignment.FOLDER}/{x}") for x in (alignment.BYTE_LEVEL, alignment.PIECES)]
    found = alignment.scored(alignment.saved(alignment.digested(docs, *sent, chunk_links=links), "t"))
    return [tuple(r) for r in found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]


@pytest.mark.parametrize("links", [1, 60, 1 << 20])
def test_against_plain(spark, links, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_BYTES", links)
    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (None, None), (3, "repeated id"), (3, "repeated id")]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(run(spark, rows, links=links), key=key) == sorted(plain(rows), key=key)


def test_nothing(spark):
    assert run(spark, []) == []


def test_lists_and_other_columns(spark):
    """The operator's own output: lists of ids, ends and counts, beside the columns as they were."""
    sent = [alignment.send(spark, f"{alignment.FOLDER}/{x}") for x in (alignment.BYTE_LEVEL, alignment.PIECES)]
    docs = spark.createDataFrame([("id", TEXTS[0], 1.5), (None, None, None)], "alignment string, text string, ends double")
    rows = alignment.alignments(docs, *sent).collect()
    assert [(r.alignment, r.ends) for r in rows] == [("id", 1.5), (None, None)]
    got, (a, b) = rows[0]._alignment, plain_tokens(TEXTS[0])
    assert (got.a_ids, got.b_ids) == ([i for i, _ in a], [i for i, _ in b])
    assert got.ends == sorted({e for _, e in a} & {e for _, e in b}) and got.ends[-1] == len(TEXTS[0]) + 1
    assert sum(got.a_counts) == len(a) and sum(got.b_counts) == len(b) and rows[1]._alignment.ends == []


def test_byte_level_ids_of_all_characters():
    """The encoder gives the ids of the file's own library, whatever a character's class, and for long runs."""
    own = alignment.ByteLevel(open(f"{alignment.FOLDER}/{alignment.BYTE_LEVEL}", "rb").read())
    texts = [" ".join(f"a{c}b 1{c}2 {c}{c} .{c}! {c}  {c}\n{c}'s" for c in map(chr, range(at, at + 16))) for at in range(0, 0x110000, 16) if not 0xD800 <= at < 0xE000]
    texts += [c * 100_000 for c in ("x", " ", "^", "\n", "1", "é", "ab")]
    for at in range(0, len(texts), 5000):
        want = byte_level().encode_batch_fast([f" {t}" for t in texts[at : at + 5000]], add_special_tokens=False)
        assert all(w.ids == g.tolist() for w, g in zip(want, own.encode(texts[at : at + 5000]), strict=True))


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        alignment.ByteLevel(open(f"{alignment.FOLDER}/word_bpe_49k.json", "rb").read())


def test_labels():
    found = alignment.label_string(np.array([2, 5, 6]), np.array([1, 5, 6]), 6)
    assert alignment.LABELS[found].tobytes() == b"BA--**"


def test_large_files_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "MOST_BYTES", 3)
    (tmp_path / "a.model").write_bytes(b"1234")
    with pytest.raises(ValueError, match="at most 3"):
        alignment.send(spark, str(tmp_path / "a.model"))
