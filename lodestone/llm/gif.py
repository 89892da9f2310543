"""GIF media columns: texts stored as grey frames, and frames decoded with LZW, palettes, disposal and transparency.

A text's UTF-8 bytes, padded with 255 to a positive multiple of 576, become 8-bit samples of frames
24 wide, compressed by LZW whose table and codes grow until it is full and then cleared. The decoder
takes any stream. It reads the codes of a table's life at once and forms no table: the entry made
behind a code is what stands in the output from that code's place on, one byte longer than its text,
so every code is a copy of earlier output, and copies of copies are followed by doubling. Frames are
drawn onto a canvas as their palettes, transparent index and disposal say, and each one has its
time and a colour histogram.

A null text is empty. Equal texts have equal files, repeated rows and null keys included; a long text
has several frames. An empty table gives an empty result, and extra columns are ignored, whatever
their names. Nothing is shuffled; files live in a column.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT, WIDTH = 576, 24
#: Rows of a frame at most: 36,864 samples.
FRAME_ROWS = 1536
DELAY_CS = 10
CLEAR, END = 256, 257
TABLE = 4096
#: Samples after which the encoder clears its table: with one entry a sample it would be full.
LIFE = TABLE - END - 1
#: Cells of the tables that stand side by side, two bytes each.
MOST_CELLS = 1 << 26
BINS = 8
GREYS = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()


def padded(raw: bytes) -> bytes:
    return raw + b"\xff" * ((-len(raw)) % UNIT if raw else UNIT)


_CELLS = np.zeros(0, np.int16)
_BITS = np.arange(12, dtype=np.uint16)


def widths_of(n: int, min_size: int) -> np.ndarray:
    """Bits of the first n codes behind a clear: the table has an entry more with each code but the first."""
    entries = np.minimum((1 << min_size) + 1 + np.maximum(np.arange(n), 1), TABLE)
    return np.clip(np.frexp(entries.astype(np.float64))[1], min_size + 1, 12)


_WIDTHS = widths_of(TABLE, 8)


def lzw_codes(parts: list[np.ndarray]) -> list[np.ndarray]:
    """The codes of each part, of LIFE samples at most, from an empty table. Parts go side by side, a sample of each at a time.
    A part's table has a row for every code and a cell for every byte that occurs in it."""
    global _CELLS
    out: list[np.ndarray] = [np.empty(0, np.uint16)] * len(parts)
    seen = [np.bincount(p, minlength=256) > 0 for p in parts]
    symbols = max((int(x.sum()) for x in seen), default=1)
    beside = max(1, MOST_CELLS // (TABLE * symbols))
    order = sorted((i for i in range(len(parts)) if len(parts[i])), key=lambda i: -len(parts[i]))
    need = min(beside, len(order)) * TABLE * symbols
    if len(_CELLS) < need:
        _CELLS = np.zeros(need, np.int16)
    for at in range(0, len(order), beside):
        chosen = order[at : at + beside]
        n, size = len(chosen), len(parts[chosen[0]])
        raw, dense = np.zeros((size, n), np.int32), np.zeros((size, n), np.int32)
        for j, i in enumerate(chosen):
            raw[: len(parts[i]), j] = parts[i]
            dense[: len(parts[i]), j] = (np.cumsum(seen[i]) - 1)[parts[i]]
        dense += np.arange(n, dtype=np.int32) * (TABLE * symbols)
        lengths = np.array([len(parts[i]) for i in chosen])
        going = n - np.searchsorted(lengths[::-1], np.arange(size), side="right")  # parts with a sample there
        words, ends = np.zeros((size, n), np.uint16), np.zeros((size, n), bool)
        word, free, touched = raw[0].copy(), np.full(n, END + 1, np.int16), []
        for t in range(1, size):
            g = going[t]
            cell = word[:g] * symbols
            cell += dense[t, :g]
            longer = _CELLS[cell].astype(np.int32)
            new = np.flatnonzero(longer == 0)
            words[t - 1, :g] = word[:g]
            if len(new):
                ends[t - 1, new] = True
                made = cell[new]
                _CELLS[made] = free[new]
                free[new] += 1
                touched.append(made)
                longer[new] = raw[t, new]
            word[:g] = longer
        for cells in touched:
            _CELLS[cells] = 0
        words[lengths - 1, np.arange(n)] = word
        ends[lengths - 1, np.arange(n)] = True
        for j, i in enumerate(chosen):
            out[i] = words[: lengths[j], j][ends[: lengths[j], j]]
    return out


def lzw_encode(samples: list[bytes]) -> list[bytes]:
    """An LZW stream of 8-bit samples each. The table grows and is cleared where it could be full."""
    lives = [[np.frombuffer(s, np.uint8)[i : i + LIFE] for i in range(0, len(s), LIFE)] for s in samples]
    codes = iter(lzw_codes([p for x in lives for p in x]))
    out = []
    for x in lives:
        found = [next(codes) for _ in x] or [np.empty(0, np.uint16)]
        flat = np.concatenate([*(np.concatenate([[CLEAR], c]) for c in found), [END]]).astype(np.uint16)
        # A clear or an end has the width that its place in the table's life asks for; the first clear has the least.
        width = np.concatenate([[9], *(_WIDTHS[: len(c) + 1] for c in found)])
        bits = (flat[:, None] >> _BITS) & 1
        out.append(np.packbits(bits[_BITS < width[:, None]].astype(bool), bitorder="little").tobytes())
    return out


def lzw_decode(data: bytes, min_size: int, expected: int) -> np.ndarray:
    """The indices of an LZW stream, as many as are expected or as it has."""
    clear = 1 << min_size
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.uint32)
    total, at, out, size = 8 * len(data), 0, [], 0
    life = widths_of(min(TABLE, total // (min_size + 1) + 1), min_size)
    while size < expected:
        width = life  # codes of one life of the table, up to its clear; beyond a full table they stay at twelve bits
        while True:
            place = at + np.cumsum(width) - width
            fits = int(np.searchsorted(place + width, total, side="right"))
            byte, shift = place[:fits] >> 3, (place[:fits] & 7).astype(np.uint32)
            codes = ((raw[byte] | raw[byte + 1] << np.uint32(8) | raw[byte + 2] << np.uint32(16)) >> shift & ((1 << width[:fits]) - 1).astype(np.uint32)).astype(np.int64)
            marks = np.flatnonzero((codes == clear) | (codes == clear + 1))
            if len(marks) or fits < len(width):
                break
            width = np.concatenate([width, np.full(len(width), 12, width.dtype)])
        if not len(marks):
            raise ValueError("the code stream ends early")
        stop = int(marks[0])
        if stop:
            part = _copied(codes[:stop], clear)
            out.append(part)
            size += len(part)
        if codes[stop] == clear + 1:
            break
        at = int(place[stop] + width[stop])
    return np.concatenate(out)[:expected] if out else np.empty(0, np.uint8)


def _copied(codes: np.ndarray, clear: int) -> np.ndarray:
    """The output of the codes between two clears."""
    n = len(codes)
    entry = codes - clear - 2  # the code that this one's table entry was made behind
    literal = entry < 0
    if (entry >= np.minimum(np.arange(n), TABLE - clear - 2)).any():
        raise ValueError("a code before its entry")
    # A text is one longer than that of the code its entry was made behind: lengths are depths, found by doubling.
    length, above = np.ones(n, np.int64), np.where(literal, -1, entry)
    while (live := np.flatnonzero(above >= 0)).size:
        length[live] += length[above[live]]
        above[live] = above[above[live]]
    start = np.cumsum(length) - length
    total = int(length.sum())
    source = np.arange(total) + np.repeat(np.where(literal, 0, start[np.maximum(entry, 0)] - start), length)
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    value = np.zeros(total, np.uint8)
    value[start[literal]] = codes[literal]
    return value[source]


def sub_blocks(data: bytes) -> bytes:
    full = len(data) // 255
    blocks = np.full((full, 256), 255, np.uint8)
    blocks[:, 1:] = np.frombuffer(data, np.uint8, full * 255).reshape(full, 255)
    rest = data[full * 255 :]
    return blocks.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def encode(payloads: list[bytes], width: int = WIDTH, frame_rows: int = FRAME_ROWS, delay_cs: int = DELAY_CS) -> list[bytes]:
    """GIF89a files whose frames, one after another, hold a payload each as samples."""
    frame = frame_rows * width
    streams = iter(lzw_encode([p[i : i + frame] for p in payloads for i in range(0, len(p), frame)]))
    out = []
    for payload in payloads:
        rows = len(payload) // width
        file = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, frame_rows), 0xF7, 0, 0), GREYS]
        for top in range(0, rows, frame_rows):
            file += [b"\x21\xf9\x04", struct.pack("<BHBB", 1 << 2, delay_cs, 0, 0), b"\x2c", struct.pack("<HHHHBB", 0, 0, width, min(frame_rows, rows - top), 0, 8)]
            file.append(sub_blocks(next(streams)))
        out.append(b"".join([*file, b"\x3b"]))
    return out


@dataclass
class Frame:
    start_ms: int
    delay_ms: int
    indices: np.ndarray
    canvas: np.ndarray


def decode(file: bytes) -> tuple[int, int, list[Frame]]:
    """(width, height, frames)."""
    if file[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, background, _ = struct.unpack_from("<HHBBB", file, 6)
    at = 13

    def palette(flags: int, at: int) -> tuple[np.ndarray | None, int]:
        if not flags & 0x80:
            return None, at
        n = 2 << (flags & 7)
        return np.frombuffer(file, np.uint8, 3 * n, at).reshape(n, 3), at + 3 * n

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while file[at]:
            parts.append(file[at + 1 : at + 1 + file[at]])
            at += 1 + file[at]
        return b"".join(parts), at + 1

    shared, at = palette(flags, at)
    picture = np.zeros((height, width, 4), np.uint8)
    frames, clock, disposal, delay, transparent = [], 0, 0, 0, None
    while at < len(file) and file[at] != 0x3B:
        if file[at] == 0x21:
            label = file[at + 1]
            data, at = blocks(at + 2)
            if label == 0xF9:
                packed, delay, index = struct.unpack_from("<BHB", data)
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
            continue
        if file[at] != 0x2C:
            raise ValueError("an unknown block")
        x, y, w, h, flags = struct.unpack_from("<HHHHB", file, at + 1)
        own, at = palette(flags, at + 10)
        min_size = file[at]
        data, at = blocks(at + 1)
        indices = lzw_decode(data, min_size, w * h)
        grid = np.zeros(w * h, np.uint8)
        grid[: len(indices)] = indices
        grid = grid.reshape(h, w)
        if flags & 0x40:
            rows = np.concatenate([np.arange(s, h, step) for s, step in ((0, 8), (4, 8), (2, 4), (1, 2))])
            straight = np.empty_like(grid)
            straight[rows] = grid
            grid = straight
        before = picture.copy() if disposal == 3 else None
        colours = own if own is not None else shared
        h2, w2 = max(0, min(h, height - y)), max(0, min(w, width - x))
        part = grid[:h2, :w2]
        area = picture[y : y + h2, x : x + w2]
        drawn = np.concatenate([colours, np.full((len(colours), 1), 255, np.uint8)], axis=1)[np.minimum(part, len(colours) - 1)]
        area[:] = drawn if transparent is None else np.where((part != transparent)[..., None], drawn, area)
        shown = picture.copy()
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            picture = before
        frames.append(Frame(clock * 10, delay * 10, indices, shown))
        clock, disposal, delay, transparent = clock + delay, 0, 0, None
    return width, height, frames


def histogram(canvas: np.ndarray) -> list[int]:
    """Counts of BINS levels for each of red, green and blue, of what is not transparent."""
    seen = canvas.reshape(-1, 4)
    seen = seen if seen[:, 3].all() else seen[seen[:, 3] > 0]
    return [int(c) for k in range(3) for c in np.bincount(seen[:, k] >> 5, minlength=BINS)]


def stored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media): a GIF for every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                raws = [x.as_py() or b"" for x in batch.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(r) for r in raws], pa.int64()), pa.array(encode([padded(r) for r in raws]), pa.binary())], names=[key, "n_bytes", "media"])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(run, f"{key} bigint, n_bytes bigint, media binary")


def features(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """What is read back from the files: payload and media digests; of the rendered frames how many, their delays in ms and the sums of their colour histograms, and a feature of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "delays_ms", "red", "green", "blue"]
        for batch in batches:
            out: list[list] = [[] for _ in names[2:]]
            for x in batch.column(2):
                file = x.as_py()
                _, _, frames = decode(file)
                payload = b"".join(f.indices.tobytes() for f in frames)
                levels = np.sum([histogram(f.canvas) for f in frames], axis=0)
                feature = f"{len(frames)}:{frames[-1].start_ms + frames[-1].delay_ms}:" + ",".join(map(str, levels.tolist()))
                colours = (levels[k * BINS : (k + 1) * BINS].tolist() for k in range(3))
                values = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(file), hashlib.sha256(file).hexdigest(), feature, len(frames), [f.delay_ms for f in frames], *colours)
                for column, v in zip(out, values, strict=True):
                    column.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), *[pa.list_(pa.int64())] * 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], names=names)

    return media.mapInArrow(run, f"{key} bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, frames int, delays_ms array<bigint>, red array<bigint>, green array<bigint>, blue array<bigint>")


def frames_of(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row a frame: frame, start_ms, delay_ms, width, height, rgba and the histogram columns' 3 x BINS counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                width, height, frames = decode(x.as_py())
                n = len(frames)
                columns = [pa.array([k] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([f.start_ms for f in frames], pa.int64()), pa.array([f.delay_ms for f in frames], pa.int64()), pa.array([width] * n, pa.int32()), pa.array([height] * n, pa.int32()), pa.array([f.canvas.tobytes() for f in frames], pa.binary()), pa.array([histogram(f.canvas) for f in frames], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "frame", "start_ms", "delay_ms", "width", "height", "rgba", "histogram"])

    return media.select(key, "media").mapInArrow(run, f"{key} bigint, frame int, start_ms bigint, delay_ms bigint, width int, height int, rgba binary, histogram array<bigint>")
