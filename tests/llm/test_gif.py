import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import gif


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.sampled_from([2, 4, 8]))
def test_code_streams_come_back(data, size):
    samples = bytes(b & ((1 << size) - 1) for b in data)
    assert gif.lzw_decode(gif.lzw_encode(samples, size), size, len(samples)) == samples


def test_table_overflow():
    samples = np.random.default_rng(1).integers(0, 256, 60_000).astype(np.uint8).tobytes()
    assert gif.lzw_decode(gif.lzw_encode(samples), 8, len(samples)) == samples


@settings(max_examples=30, deadline=None)
@given(st.text(max_size=400))
def test_payloads_come_back(text):
    payload, n = gif.padded(text)
    back, frames, shown, histogram = gif.payload_of(gif.encode(payload))
    assert back == payload and back[:n] == text.encode("utf-8", "surrogatepass") and set(back[n:]) <= {32}
    assert len(back) % 192 == 0 and frames >= 1 and shown == 40 * frames and histogram.sum() == len(back)


def image(*frames, size=(4, 4), palette=b"\0\0\0\xff\0\0\0\xff\0\0\0\xff"):
    """frames: (left, top, width, height, samples, disposal, transparent or None, interlaced)."""
    out = [b"GIF89a", size[0].to_bytes(2, "little"), size[1].to_bytes(2, "little"), b"\x81\0\0", palette]
    for left, top, w, h, samples, disposal, clear, lace in frames:
        out.append(b"\x21\xf9\x04" + bytes((disposal << 2 | (clear is not None), 7, 0, clear or 0)) + b"\0")
        out.append(b"\x2c" + b"".join(x.to_bytes(2, "little") for x in (left, top, w, h)) + bytes((0x40 * lace, 2)))
        stream = gif.lzw_encode(bytes(samples), 2)
        out.append(bytes((len(stream),)) + stream + b"\0")
    return b"".join([*out, b"\x21\xfe\x03abc\0\x3b"])


def test_disposal_and_transparency():
    data = image((0, 0, 4, 4, [1] * 16, 1, None, 0), (1, 1, 2, 2, [2, 0, 0, 2], 2, 0, 0), (0, 0, 1, 1, [3], 3, None, 0), (3, 3, 1, 1, [2], 0, None, 0))
    a, b, c, d = gif.decode(data)
    assert (a.canvas[..., 0] == 255).all() and a.delay_ms == 70
    assert b.canvas[1, 1].tolist() == [0, 255, 0, 255] and b.canvas[1, 2].tolist() == [255, 0, 0, 255]  # 0 is transparent
    assert c.canvas[1, 1, 3] == 0 and c.canvas[0, 0].tolist() == [0, 0, 255, 255]  # frame 2 gave way to the background
    assert d.canvas[0, 0].tolist() == [255, 0, 0, 255] and d.canvas[3, 3].tolist() == [0, 255, 0, 255]  # frame 3 was undone


def test_interlace():
    rows = [[r % 4] * 2 for r in range(10)]
    order = [0, 8, 4, 2, 6, 1, 3, 5, 7, 9]
    (f,) = gif.decode(image((0, 0, 2, 10, [x for r in order for x in rows[r]], 0, None, 1), size=(2, 10)))
    assert f.samples.tolist() == rows


@pytest.mark.parametrize("data", [b"", b"GIF89a", b"PNG", b"GIF89a\1\0\1\0\0\0\0\x2c"])
def test_broken(data):
    with pytest.raises(gif.GifError):
        list(gif.decode(data))


def test_every_broken_image_raises_the_same_error():
    whole = image((0, 0, 4, 4, [1] * 16, 1, None, 0), (1, 1, 2, 2, [2, 0, 0, 2], 2, 0, 0))
    for at in range(len(whole)):
        for data in (whole[:at], whole[:at] + bytes((whole[at] ^ 0xFF,)) + whole[at + 1 :]):
            try:
                list(gif.decode(data))
            except gif.GifError:
                pass
    with pytest.raises(gif.GifError):
        list(gif.decode(whole[:6] + b"\xff\xff\xff\xff" + whole[10:]))


def plain_decoder(data):
    """Another decoder, code by code and pixel by pixel, of images like encode()'s: the greys of all frames in order."""
    assert data[:6] == b"GIF89a" and data[10] & 0x80
    n = 2 << (data[10] & 7)
    palette, at, out = [data[13 + 3 * i] for i in range(n)], 13 + 3 * n, []
    while data[at] != 0x3B:
        if data[at] == 0x21:
            at += 2
        else:
            assert data[at] == 0x2C
            w, h, size = int.from_bytes(data[at + 5 : at + 7], "little"), int.from_bytes(data[at + 7 : at + 9], "little"), data[at + 10]
            at += 11
            stream = b""
            while data[at]:
                stream += data[at + 1 : at + 1 + data[at]]
                at += 1 + data[at]
            bits, place, width, table, before, pixels = int.from_bytes(stream, "little"), 0, size + 1, {}, None, []
            while True:
                code, place = bits >> place & (1 << width) - 1, place + width
                if code == 1 << size:
                    table, before, width = {i: [i] for i in range(1 << size)}, None, size + 1
                    table[1 << size] = table[(1 << size) + 1] = []
                    continue
                if code == (1 << size) + 1:
                    break
                entry = table[code] if code in table else before + before[:1]
                pixels += entry
                if before is not None and len(table) < 4096:
                    table[len(table)] = before + entry[:1]
                    if len(table) == 1 << width and width < 12:
                        width += 1
                before = entry
            assert len(pixels) == w * h
            out += [palette[p] for p in pixels]
            at += 1
            continue
        while data[at]:
            at += 1 + data[at]
        at += 1
    return bytes(out)


@pytest.mark.parametrize("text", ["", "a", "hello world " * 40, "\u20ac\xe4" * 9000, "".join(chr(32 + i * i % 90) for i in range(30_000))])
def test_against_another_decoder(spark, text):
    payload, _ = gif.padded(text)
    assert plain_decoder(gif.encode(payload)) == payload
    row = gif.stored(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    raw = text.encode()
    want = raw + b" " * ((192 - len(raw) if not raw else -len(raw) % 192))
    assert plain_decoder(row.gif) == want and (row.n_bytes, row.payload_bytes, row.payload_sha256, row.tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-16:]))


def test_operator(spark, odd, nothing):
    rows = gif.stored(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert hashlib.sha256(r.gif).hexdigest() == r.media_sha256 and r.payload_bytes % 192 == 0
    empty = [r for r in rows if r.n_bytes == 0]
    assert len(empty) == 2 and {r.payload_sha256 for r in empty} == {hashlib.sha256(b" " * 192).hexdigest()} and {r.tail_crc32 for r in empty} == {zlib.crc32(b" " * 16)}
    same = [r for r in rows if r.doc_id in (1, 2)]
    assert same[0].asDict() | {"doc_id": 0} == same[1].asDict() | {"doc_id": 0}
    assert gif.stored(nothing).count() == 0
    media = spark.createDataFrame([(1, bytes(rows[0].gif)), (2, None), (3, b"junk")], "id long, gif binary")
    frames = gif.frames_table(media).collect()
    assert {f.id for f in frames} == {1} and [f.frame for f in frames] == list(range(len(frames)))
