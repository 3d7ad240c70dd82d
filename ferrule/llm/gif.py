"""GIF media columns: code streams, palettes, disposal, transparency, timed frames and their colour histograms.

decode() reads any GIF87a or GIF89a image, interlaced ones included, and composes its frames on the canvas.
encode() writes 8-bit samples losslessly as an animation: each frame is WIDTH samples wide, its palette maps each
sample to the grey of that value, and frames follow one another without transparency.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.llm.common import with_values

#: Samples in a row and rows in a frame of an encoded payload; hundredths of a second that a frame is shown.
WIDTH, ROWS, DELAY = 192, 64, 4
UNIT = 192
#: Fixed values of the format.
KEEP, TO_BACKGROUND, TO_PREVIOUS = 1, 2, 3
MOST_CODES = 4096
HISTOGRAM_BITS = 2  # of each colour channel
#: Pixels of a canvas or frame that decode() takes at the most; the format allows four thousand million.
MOST_PIXELS = 1 << 26

_GREYS = bytes(b for i in range(256) for b in (i, i, i))


class GifError(ValueError):
    """The bytes are not a whole GIF image."""


@dataclass
class Frame:
    """A frame as shown: the canvas in RGBA, the milliseconds it is shown, and what its own block held."""

    canvas: np.ndarray
    delay_ms: int
    samples: np.ndarray
    left: int
    top: int
    disposal: int
    transparent: int | None


def _pattern(size: int, n: int = 2 * MOST_CODES) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the n codes that follow a clear code, and their bit offsets: a code is wide enough for the table's next entry."""
    key = (size, max(n, 2 * MOST_CODES))
    if key not in _PATTERNS:
        following = np.minimum((1 << size) + 2 + np.maximum(np.arange(key[1]) - 1, 0), MOST_CODES - 1)
        widths = np.maximum(np.frexp(following.astype(np.float64))[1], size + 1).astype(np.int64)
        if key[1] > 2 * MOST_CODES:
            return widths, np.concatenate(([0], np.cumsum(widths)))
        _PATTERNS[key] = (widths, np.concatenate(([0], np.cumsum(widths))))
    return _PATTERNS[key]


_PATTERNS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def lzw_encode(samples: bytes, size: int = 8) -> bytes:
    """The code stream of samples below 2 ** size: clear code first and whenever the table is full, end code last."""
    clear, out = 1 << size, []
    add = out.append
    width_of, _ = _pattern(size)
    add(clear)
    table: dict[int, int] = {}
    get, free = table.get, clear + 2
    rest = iter(samples)
    word = next(rest, None)
    for c in rest:
        key = word << 8 | c
        known = get(key)
        if known is None:
            add(word)
            word = c
            if free < 4096:
                table[key] = free
                free += 1
            else:
                add(clear)
                table.clear()
                free = clear + 2
        else:
            word = known
    if word is not None:
        add(word)
    add(clear + 1)
    codes = np.array(out, np.uint16)
    # between two clear codes the widths follow the pattern; the clear code itself ends its run
    clears = np.concatenate(([0], np.flatnonzero(codes[1:] == clear) + 1))
    ends = np.append(clears[1:] + 1, len(codes))
    widths = np.empty(len(codes), np.int64)
    widths[0] = size + 1
    for a, b in zip(clears.tolist(), ends.tolist(), strict=True):
        widths[a + 1 : b] = width_of[: b - a - 1]
    return _packed(codes, widths)


def _packed(codes: np.ndarray, widths: np.ndarray) -> bytes:
    places = np.arange(12, dtype=np.uint16)
    bits = (codes[:, None] >> places & np.uint16(1)).astype(bool)
    return np.packbits(bits[places < widths[:, None]], bitorder="little").tobytes()


def lzw_decode(stream: bytes, size: int, most: int) -> bytes:
    """The samples of a code stream, `most` at the most; stops at the end code or where the stream ends."""
    clear, end = 1 << size, (1 << size) + 1
    raw = np.frombuffer(stream + b"\0" * 4, np.uint8).astype(np.uint32)
    words = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16)
    start, total = [bytes((i,)) for i in range(clear)] + [b"", b""], 8 * len(stream)
    out: list[bytes] = []
    made, at = 0, 0
    while at + size + 1 <= total and made < most:
        # the codes up to the next clear or end code have known widths
        width_of, offset_of = _pattern(size)
        if offset_of[-1] < total - at:
            # an encoder may leave the table full; try a usual run first
            head = at + offset_of[:-1]
            near = (words[head >> 3] >> (head & 7).astype(np.uint32)) & ((np.uint32(1) << width_of.astype(np.uint32)) - np.uint32(1))
            if not ((near == clear) | (near == end)).any():
                width_of, offset_of = _pattern(size, (total - at) // (size + 1) + 1)
        n = min(int(np.searchsorted(offset_of, total - at, "right")) - 1, len(width_of))
        places = at + offset_of[:n]
        codes = (words[places >> 3] >> (places & 7).astype(np.uint32)) & ((np.uint32(1) << width_of[:n].astype(np.uint32)) - np.uint32(1))
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else n
        table = start.copy()
        before = b""
        known = len(table)
        add, grow = out.append, table.append
        rest = iter(codes[:stop].tolist())
        for code in rest:  # the first
            if code >= clear:
                raise GifError("a code that isn't in the table")
            before = table[code]
            add(before)
            break
        for code in rest:
            if code < known:
                entry = table[code]
            elif code == known:
                entry = before + before[:1]
            else:
                raise GifError("a code that isn't in the table")
            add(entry)
            if known < 4096:
                grow(before + entry[:1])
                known += 1
            before = entry
        made = sum(map(len, out)) if stop < n else most
        if not len(stops) or int(codes[stop]) == end:
            break
        at = int(places[stop]) + int(width_of[stop])
    return b"".join(out)[:most]


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += data[at] + 1
    if at >= len(data):
        raise GifError("ends within a block")
    return b"".join(parts), at + 1


def _rows_in_order(rows: int) -> np.ndarray:
    """Where the rows of an interlaced image go."""
    return np.concatenate([np.arange(a, rows, step) for a, step in ((0, 8), (4, 8), (2, 4), (1, 2))])


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    n = 3 * (2 << (flags & 7))
    if at + n > len(data):
        raise GifError("ends within a palette")
    return np.frombuffer(data[at : at + n], np.uint8).reshape(-1, 3), at + n


def _byte(data: bytes, at: int) -> int:
    if at >= len(data):
        raise GifError("ends too early")
    return data[at]


def decode(data: bytes, most_pixels: int = MOST_PIXELS) -> Iterator[Frame]:
    """The frames, one after another, each composed on what the one before left.

    Whatever isn't a whole image raises GifError: a truncated header, palette or block, a code size that the format
    doesn't have, a code that isn't in the table. So does a canvas or frame of more than most_pixels.
    """
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise GifError("no GIF header")
    width, height, flags = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little"), data[10]
    if width * height > most_pixels:
        raise GifError("a canvas above the limit")
    at, shared = 13, None
    if flags & 0x80:
        shared, at = _palette(data, at, flags)
    canvas = np.zeros((height, width, 4), np.uint8)
    delay, disposal, transparent = 0, 0, None
    while at < len(data):
        kind, at = data[at], at + 1
        if kind == 0x3B:
            return
        if kind == 0x21:
            label, at = _byte(data, at), at + 1
            block, at = _blocks(data, at)
            if label == 0xF9 and len(block) >= 4:
                disposal, delay = block[0] >> 2 & 7, 10 * int.from_bytes(block[1:3], "little")
                transparent = block[3] if block[0] & 1 else None
            continue
        if kind != 0x2C or at + 9 > len(data):
            raise GifError("unknown block")
        left, top, w, h = (int.from_bytes(data[at + i : at + i + 2], "little") for i in (0, 2, 4, 6))
        own, at = data[at + 8], at + 9
        palette = shared
        if w * h > most_pixels:
            raise GifError("a frame above the limit")
        if own & 0x80:
            palette, at = _palette(data, at, own)
        if palette is None:
            raise GifError("no palette")
        size, at = _byte(data, at), at + 1
        if not 2 <= size <= 8:
            raise GifError("no code size of the format")
        stream, at = _blocks(data, at)
        found = lzw_decode(stream, size, w * h)
        samples = np.zeros(w * h, np.uint8)
        samples[: len(found)] = np.frombuffer(found, np.uint8)
        samples = samples.reshape(h, w)
        if own & 0x40:
            upright = np.empty_like(samples)
            upright[_rows_in_order(h)] = samples
            samples = upright
        before = canvas.copy() if disposal == TO_PREVIOUS else None
        area = canvas[top : top + h, left : left + w]
        seen = samples[: area.shape[0], : area.shape[1]]
        if transparent is None and len(palette) == 256:
            area[..., :3] = palette[seen]
            area[..., 3] = 255
        else:
            shown = seen < len(palette)
            if transparent is not None:
                shown &= seen != transparent
            area[shown, :3] = palette[seen[shown]]
            area[shown, 3] = 255
        yield Frame(canvas.copy(), delay, samples, left, top, disposal, transparent)
        if disposal == TO_BACKGROUND:
            area[...] = 0
        elif before is not None:
            canvas = before
        delay, disposal, transparent = 0, 0, None


def encode(samples: bytes) -> bytes:
    """Samples, a positive multiple of WIDTH of them, as an animation of grey frames."""
    if not samples or len(samples) % WIDTH:
        raise ValueError(f"not a positive multiple of {WIDTH} samples")
    step = WIDTH * ROWS
    out = [b"GIF89a", WIDTH.to_bytes(2, "little"), min(ROWS, len(samples) // WIDTH).to_bytes(2, "little"), b"\xf7\0\0", _GREYS]
    for at in range(0, len(samples), step):
        part = samples[at : at + step]
        stream = lzw_encode(part)
        out += [b"\x21\xf9\x04", bytes((KEEP << 2,)), DELAY.to_bytes(2, "little"), b"\0\0\x2c\0\0\0\0", WIDTH.to_bytes(2, "little"), (len(part) // WIDTH).to_bytes(2, "little"), b"\0\x08"]
        out += [y for i in range(0, len(stream), 255) for y in (bytes((len(stream[i : i + 255]),)), stream[i : i + 255])]
        out.append(b"\0")
    return b"".join([*out, b"\x3b"])


def payload_of(media: bytes) -> tuple[bytes, int, int, np.ndarray]:
    """What encode() stored, read back from the composed colours; frames, milliseconds, histogram of the colours."""
    parts, frames, shown = [], 0, 0
    histogram = np.zeros(1 << 3 * HISTOGRAM_BITS, np.int64)
    for frame in decode(media):
        h, w = frame.samples.shape
        colours = frame.canvas[frame.top : frame.top + h, frame.left : frame.left + w]
        parts.append(colours[..., 0].tobytes())
        histogram += histogram_of(colours)
        frames += 1
        shown += frame.delay_ms
    return b"".join(parts), frames, shown, histogram


def histogram_of(colours: np.ndarray) -> np.ndarray:
    """Number of opaque pixels by the upper HISTOGRAM_BITS of red, green and blue."""
    down = np.uint8(8 - HISTOGRAM_BITS)
    red, green, blue = (colours[..., i] >> down for i in range(3))
    index = (red << np.uint8(2 * HISTOGRAM_BITS) | green << np.uint8(HISTOGRAM_BITS) | blue)[colours[..., 3] == 255]
    return np.bincount(index, minlength=1 << 3 * HISTOGRAM_BITS)


def padded(text: str | None) -> tuple[bytes, int]:
    """The UTF-8 bytes with blanks up to a positive multiple of UNIT, and how many there were before."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b" " * (UNIT - len(raw) if not raw else -len(raw) % UNIT), len(raw)


def frames_table(media: DataFrame) -> DataFrame:
    """One row per timed frame of media (id, gif): id, frame, at_ms, delay_ms, left, top, width, height, disposal,
    transparent (null: none), histogram. A null or broken image, or one above MOST_PIXELS, has no frames; repeated rows
    give their frames again; other columns are ignored; an empty table gives an empty result."""

    kind = dict(media.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", "frame", "at_ms", "delay_ms", "left", "top", "width", "height", "disposal", "transparent", "histogram"]
        for batch in batches:
            rows = []
            for key, data in zip(batch["id"], batch["gif"], strict=True):
                own, clock = [], 0
                try:
                    for i, f in enumerate(decode(data or b"")):
                        own.append((key, i, clock, f.delay_ms, f.left, f.top, f.samples.shape[1], f.samples.shape[0], f.disposal, f.transparent, histogram_of(f.canvas).tolist()))
                        clock += f.delay_ms
                except GifError:
                    own = []
                rows += own
            out = pd.DataFrame(rows, columns=names)
            out["transparent"] = out["transparent"].astype("Int32")
            yield out

    # the id travels as text: a null among numbers would turn them all into doubles
    found = media.select(F.col("id").cast("string"), "gif").mapInPandas(run, "id string, frame int, at_ms long, delay_ms long, left int, top int, width int, height int, disposal int, transparent int, histogram array<long>")
    return found.withColumn("id", F.col("id").cast(kind))


def stored(docs: DataFrame, keep_media: bool = True) -> DataFrame:
    """Each row's text as a GIF and what is read back from it: doc_id, gif (unless keep_media is false), n_bytes,
    payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, n_frames, duration_ms, histogram.

    A null text is the empty one. A text of any length is stored whole, in as many frames as it needs. Equal texts give
    equal values; repeated rows stay repeated; doc_id is whatever it was, null included; other columns are ignored; an
    empty table gives an empty result.
    """

    def row(text: str | None) -> tuple:
        payload, n = padded(text)
        media = encode(payload)
        back, frames, shown, histogram = payload_of(media)
        share = (255 * histogram[[0, 21, 42, 63]] // max(1, int(histogram.sum()))).tolist()
        feature = f"gif:{WIDTH}x{len(back) // WIDTH}:{frames}f:{shown}ms:" + "".join(f"{x:02x}" for x in share)
        out = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, frames, shown, histogram.tolist())
        return (media, *out) if keep_media else out

    fields = f"{'gif binary, ' if keep_media else ''}n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, duration_ms long, histogram array<long>"
    return with_values(docs.select("doc_id", "text"), fields, lambda texts: map(row, texts), rows=100).drop("text")


def query(spark, sf_dir: str) -> DataFrame:
    return stored(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_media=False)
