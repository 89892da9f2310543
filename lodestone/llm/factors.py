"""Dedup of byte strings of a minimum length that occur again, by longest-previous-factor values over sparse suffix order.

A position's longest previous factor (LPF) is the longest string starting there that also starts at
an earlier position. It is the longer of the matches with the previous and with the next smaller
position in suffix order. Where it reaches a minimum length, the bytes it covers are a later copy.
A suffix array of all positions of a table would be one global sort; here suffix order is built
where a factor of the minimum length can start at all:

1. Every window of min_length bytes has one anchor, the least-hashed gram of half that length in
   it, so equal windows have equal anchors at equal offsets. Anchors whose gram occurs once in the
   table are dropped; that is nearly all of them.
2. Rows are the remaining anchors with the bytes before and behind that a window can reach. Within a
   gram, rows stand in suffix order of the bytes behind, and the common endings of the bytes before
   make a tree. For each node of the tree, that is for the suffixes starting `depth` bytes before
   their anchors, one pass for previous and next smaller positions gives the LPF of every row.
3. A row's factors of sufficient length all hold its anchor, so they are one span; spans are merged
   for each text and cut out.

A gram with more than GROUP_ROWS rows is no group for one task. Whether the LPF of a row reaches the
minimum is then told by an exact aggregate over hashes of its windows, with the same spans; nothing
is left out, and no task holds more than a bounded group.

keep="none" removes every occurrence, keep="first" all but the first by (doc_id, position), in any
case judged on the input. Whole copies of a text are handled by their digest. With `passages` also
the text is returned of which later copies of that (smaller) length are cut, the first one staying.

A null text is empty; texts shorter than the minimum keep all bytes, however long ones are taken
whole. Rows with a null doc_id take part as the first of all documents; rows that share a doc_id are
told apart by their texts, and a row that is there twice is one document. An empty table gives an
empty result. Extra columns, whatever their names, are carried by whole_rows and else ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ._common import parts, runs, written

MIN_LENGTH = 400
#: Bytes of a passage: 51 words, at the least of 4.9 bytes a word with its blank that ordinary text has.
PASSAGE = 250
#: Rows of a gram that a task looks at together, some 400 bytes each; beyond, their windows are counted.
GROUP_ROWS = 50_000
#: Entries of tree nodes that are worked on together.
NODE_ROWS = 1 << 17
#: Grams looked at together, and bits of their places in a combined value.
PLACE_BITS = 20
BATCH_ROWS = 8_192

_BYTE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k bytes."""
    n = len(data)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes): in every min_length bytes, the leftmost of the least-hashed grams."""
    w = min_length // 2
    k = min_length - w + 1
    if len(data) < min_length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(data, k)
    step, low, found = (1 << PLACE_BITS) - w, np.uint64((1 << PLACE_BITS) - 1), []
    for start in range(0, len(h) - w + 1, step):
        part = h[start : start + step + w - 1]
        value = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        padded = np.full(-(-len(value) // w) * w, ~np.uint64(0), np.uint64)
        padded[: len(value)] = value
        blocks = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(value) - w + 1
        least = np.minimum(behind[:count], ahead[w - 1 : w - 1 + count])
        found.append(np.unique(least & low).astype(np.int64) + start)
    places = np.unique(np.concatenate(found))
    return places, h[places]


def agreement(rows: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp) of fixed-width byte rows within groups; bytes are 1 to 255, and 0 pads."""
    tagged = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4) | 0, rows], axis=1)
    order = np.argsort(np.ascontiguousarray(tagged).view(f"S{tagged.shape[1]}").ravel(), kind="stable")
    a = rows[order]
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = a[1:] != a[:-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        same = np.minimum(same, np.minimum(lengths[order][1:], lengths[order][:-1]))
        lcp[1:] = np.where(group[order][1:] == group[order][:-1], same, -1)
    lcp[:1] = -1
    return order, lcp


def smaller_before(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, -1 for none, by pointer jumping; at: the place before, or -1 where none may be passed."""
    while True:
        live = np.flatnonzero(at >= 0)
        over = live[values[at[live]] >= values[live]]
        if not len(over):
            return at
        at[over] = at[at[over]]


def smaller_on_both_sides(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous, next) smaller places within runs; first marks where a run begins; -1 for none."""
    n = len(values)
    before = smaller_before(values, np.where(first, -1, np.arange(n) - 1))
    ends = np.append(first[1:], True)[::-1]
    after = smaller_before(values[::-1], np.where(ends, -1, np.arange(n) - 1))[::-1]
    return before, np.where(after < 0, -1, n - 1 - after)


class RangeMinimum:
    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least value in places start to end - 1 of each pair."""
        out = np.empty(len(start), np.int64)
        level = np.frexp((end - start).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][start[at]], self.levels[k][end[at] - (1 << int(k))])
        return out


def side(contexts: list[bytes], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as rows of a fixed width, bytes 1 to 255 and 0 behind the end, and their lengths."""
    size = np.array([len(x) for x in contexts], np.int64)
    m = np.zeros((len(contexts), reach), np.uint8)
    m[np.arange(reach) < size[:, None]] = np.frombuffer(b"".join(contexts), np.uint8) + 1
    return m, size


def longest_factors(group: np.ndarray, left: list[bytes], right: list[bytes], reach: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, depth, previous, any) for the suffixes that start depth bytes before their anchors: how far behind the gram the longest
    match with an earlier row, and with any other, goes; -1 for none. Rows stand in the order of their positions within their group;
    left is reversed. Given in parts of some NODE_ROWS entries."""
    n = len(left)
    lo, ll = agreement(*side(left, reach[0]), group)
    ro, rl = agreement(*side(right, reach[1]), group)
    rank = np.empty(n, np.int64)
    rank[ro] = np.arange(n)
    least = RangeMinimum(rl)
    # The tree over common endings: each of its nodes is a run of rows in left order, bounded by smaller agreements.
    low, high = smaller_on_both_sides(ll, np.arange(n) == 0)
    inner = np.flatnonzero(ll >= 0)
    ends, at = np.unique(low[inner] * np.int64(n + 1) + np.where(high[inner] < 0, n, high[inner]), return_index=True)
    starts, sizes, depths = ends // (n + 1), ends % (n + 1) - ends // (n + 1), ll[inner[at]]
    part = np.cumsum(sizes) // NODE_ROWS
    for cut in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(part)) + 1):
        if len(cut):
            yield _of_nodes(lo, rank, least, starts[cut], sizes[cut], depths[cut])


def _of_nodes(lo: np.ndarray, rank: np.ndarray, least: RangeMinimum, starts: np.ndarray, sizes: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The factors of the rows of some nodes: one pass in suffix order for previous and next smaller positions."""
    node = np.repeat(np.arange(len(sizes)), sizes)
    row = lo[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
    order = np.lexsort((rank[row], node))
    node, row = node[order], row[order]
    place = rank[row]
    first = np.append(True, node[1:] != node[:-1])
    before, after = smaller_on_both_sides(row, first)

    def match(i: np.ndarray, j: np.ndarray, there: np.ndarray) -> np.ndarray:
        out = np.full(len(row), -1, np.int64)
        out[there] = least(place[i[there]] + 1, place[j[there]] + 1)
        return out

    every = np.arange(len(row))
    previous = np.maximum(match(before, every, before >= 0), match(every, after, after >= 0))
    last = np.append(first[1:], True)
    return row, depths[node], previous, np.maximum(match(every - 1, every, ~first), match(every, every + 1, ~last))


def spans_of(parts: Iterable[tuple[np.ndarray, ...]], n: int, k: int, leasts: dict[bool, int | None]) -> dict[bool, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For matches with earlier rows (True) and with any (False): (rows, bytes before the anchor, bytes behind the gram) of each row's
    factors of at least so many bytes; they overlap in the anchor, so they are one span."""
    out = {e: np.full((2, n), -1, np.int64) for e, least in leasts.items() if least}
    for row, depth, previous, other in parts:
        for e, ends in out.items():
            beyond = previous if e else other
            held = np.flatnonzero((beyond >= 0) & (depth + k + beyond >= leasts[e]))
            np.maximum.at(ends[0], row[held], depth[held])
            np.maximum.at(ends[1], row[held], beyond[held])
    none = np.empty(0, np.int64)
    return {e: (rows := np.flatnonzero(out[e][0] >= 0), *out[e][:, rows]) if e in out else (none, none, none) for e in (True, False)}


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def _digest(text: bytes) -> bytes:
    return xxhash.xxh128_digest(text)


def _anchored(docs: DataFrame, min_length: int) -> DataFrame:
    """(gram, id, digest, often) for each text's distinct grams; often: at more than one place in it. A periodic text has one row a gram, however long it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            out: list[list] = [[], [], [], []]
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                raw = x.as_py()
                _, h = anchors(np.frombuffer(raw, np.uint8), min_length)
                if len(h):
                    grams, n = np.unique(h, return_counts=True)
                    out[0].append(grams.view(np.int64))
                    out[1].append((k, len(grams)))
                    out[2].append(np.full(len(grams), np.frombuffer(_digest(raw), np.int64)[0]))
                    out[3].append(n > 1)
            if out[0]:
                counts = pa.array(np.repeat(np.arange(len(out[1])), [n for _, n in out[1]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[0])), pa.array([k for k, _ in out[1]], pa.int64()).take(counts), pa.array(np.concatenate(out[2])), pa.array(np.concatenate(out[3]))], names=["gram", "id", "digest", "often"])

    return docs.mapInArrow(run, "gram bigint, id bigint, digest bigint, often boolean")


class Lengths(NamedTuple):
    """Minimum lengths: of factors that occur earlier (`first`) and of those that occur anywhere else (`any`)."""

    first: int | None
    any: int | None

    @property
    def least(self) -> int:
        return min(x for x in self if x)

    @property
    def gram(self) -> int:
        return self.least - self.least // 2 + 1

    @property
    def reach(self) -> tuple[int, int]:
        """Bytes before an anchor and behind its gram that the longest window can hold."""
        return self.least // 2 - 1, max(x for x in self if x) - self.gram


_SPAN = "id bigint, digest bigint, start bigint, end bigint, earlier boolean"


def _span_batch(ids: pa.Array, digests: pa.Array, places: np.ndarray, found: dict[bool, tuple], k: int) -> pa.RecordBatch:
    rows = np.concatenate([found[e][0] for e in (True, False)])
    start = np.concatenate([places[r] - d for r, d, _ in (found[e] for e in (True, False))])
    end = np.concatenate([places[r] + k + f for r, _, f in (found[e] for e in (True, False))])
    earlier = np.repeat([True, False], [len(found[True][0]), len(found[False][0])])
    at = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([ids.take(at), digests.take(at), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(earlier)], names=["id", "digest", "start", "end", "earlier"])


def _contexts(docs: DataFrame, lengths: Lengths) -> DataFrame:
    """For texts with the grams that are repeated: their anchors are found again. Rows (gram, id, digest, place, left, right), and spans of contexts that repeat within the text itself."""
    k, (before, behind) = lengths.gram, lengths.reach
    names = ["gram", "id", "digest", "place", "left", "right", "start", "end", "earlier"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows: list[list] = [[] for _ in names]

            def add(*values, rows=rows):
                for column, v in zip(rows, values, strict=True):
                    column.append(v)

            for key, x, grams in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                raw = x.as_py()
                (d,) = np.frombuffer(_digest(raw), np.int64)[:1].tolist()
                seen: dict[tuple, list[int]] = {}
                places, h = anchors(np.frombuffer(raw, np.uint8), lengths.least)
                wanted = np.isin(h.view(np.int64), grams.values.to_numpy())
                for place, gram in zip(places[wanted].tolist(), h.view(np.int64)[wanted].tolist(), strict=True):
                    left, right = raw[max(0, place - before) : place][::-1], raw[place + k : place + k + behind]
                    seen.setdefault((gram, left, right), []).append(place)
                for (gram, left, right), at in seen.items():
                    add(gram, key, d, at[0], left, right, None, None, None)
                    size = len(left) + k + len(right)
                    for earlier, least, again in ((True, lengths.first, at[1:]), (False, lengths.any, at)):
                        if least and size >= least and len(at) > 1:
                            for p in again:
                                add(None, key, d, None, None, None, p - len(left), p + k + len(right), earlier)
                if len(rows[0]) > BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=names)
                    for c in rows:
                        c.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=names)

    return docs.mapInArrow(run, "gram bigint, id bigint, digest bigint, place int, left binary, right binary, start bigint, end bigint, earlier boolean")


_ROW = ["gram", "id", "digest", "place", "left", "right"]


def _grouped(rows: DataFrame, lengths: Lengths) -> DataFrame:
    """Spans from the rows of grams, gram by gram; many small groups are worked on together."""
    k = lengths.gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def work() -> pa.RecordBatch:
            t = pa.concat_tables([x for _, x in held]).combine_chunks()
            group = np.repeat(np.arange(1, len(held) + 1), [x.num_rows for _, x in held])
            factors = longest_factors(group, t.column(4).to_pylist(), t.column(5).to_pylist(), lengths.reach)
            found = spans_of(factors, t.num_rows, k, {True: lengths.first, False: lengths.any})
            return _span_batch(t.column(1).chunk(0), t.column(2).chunk(0), t.column(3).to_numpy().astype(np.int64), found, k)

        for gram, t in runs(batches):
            d, p = t.column(2).to_numpy(), t.column(3).to_numpy()
            t = t.filter(pa.array(np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1])])))  # a row that is there twice is one document
            if t.num_rows > 1:
                held.append((gram, t))
                size += t.num_rows
            if size >= BATCH_ROWS:
                yield work()
                held, size = [], 0
        if held:
            yield work()

    ordered = rows.select(*_ROW).repartition("gram").sortWithinPartitions("gram", F.col("id").asc_nulls_first(), "digest", "place")
    return ordered.mapInArrow(run, _SPAN)


def _counted(rows: DataFrame, lengths: Lengths) -> DataFrame:
    """Spans of grams with more rows than a task should hold, by an aggregate over hashes of their windows, which is combined before
    it is dealt: a window's least position is its first occurrence. A row's windows hold its anchor, so they are one span again."""
    k, before = lengths.gram, lengths.reach[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, key, d, place, left, right in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                data = np.frombuffer(left[::-1] + right, np.uint8)
                for earlier, least in ((True, lengths.first), (False, lengths.any)):
                    if not least or len(data) < least - k:
                        continue
                    hashes = gram_hashes(data, least - k).view(np.int64)[max(0, len(left) - before) : len(left) + 1]
                    n = len(hashes)
                    offsets = len(left) - max(0, len(left) - before) - np.arange(n)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), *(pa.repeat(pa.scalar(v, t), n) for v, t in ((gram, pa.int64()), (key, pa.int64()), (d, pa.int64()), (place, pa.int32()), (earlier, pa.bool_()))), pa.array(offsets.astype(np.int32))], names=["window", "gram", "id", "digest", "place", "earlier", "t"])

    windows = rows.select(*_ROW).mapInArrow(run, "window bigint, gram bigint, id bigint, digest bigint, place int, earlier boolean, t int")
    at = F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "digest", "place")
    found = windows.groupBy("gram", "earlier", "t", "window").agg(F.min(at).alias("low"), F.max(at).alias("high")).where("low <> high")
    back = windows.join(found, ["gram", "earlier", "t", "window"]).where(~F.col("earlier") | (at != F.col("low")))
    size = F.when(F.col("earlier"), F.lit(lengths.first)).otherwise(F.lit(lengths.any))
    ends = back.groupBy("gram", "id", "digest", "place", "earlier").agg(F.min(F.col("place") - F.col("t")).alias("start"), F.max(F.col("place") - F.col("t") + size).alias("end"))
    return ends.select("id", "digest", F.col("start").cast("long"), F.col("end").cast("long"), "earlier")


def _cut(texts: DataFrame, lengths: Lengths, own: list[str], text_out: bool) -> DataFrame:
    """Applies spans to rows (own columns, text, spans, whole, later): own columns, the numbers and, if asked for, the text without later copies."""
    numbers = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sizes, removed, count, digests, cut, kept = [], [], [], [], [], []
            lists, values = batch.column("spans"), batch.column("spans").values
            at = lists.offsets.to_numpy().tolist()
            start, end, earlier = (values.field(f).to_numpy(zero_copy_only=False) for f in ("start", "end", "earlier"))
            for i, (x, whole, later) in enumerate(zip(batch.column("text").cast(pa.binary()), batch.column("whole").to_pylist(), batch.column("later").to_pylist(), strict=True)):
                raw, own_ = x.as_py(), slice(at[i], at[i + 1])
                of = [merge(zip(start[own_][e].tolist(), end[own_][e].tolist(), strict=True)) for e in (earlier[own_], ~earlier[own_])] if at[i] < at[i + 1] else [[], []]
                if later and raw:
                    of[0] = [[0, len(raw)]]
                if whole and raw:
                    of[1] = [[0, len(raw)]]
                merged = of[1] if lengths.any else of[0]
                sizes.append(len(raw))
                removed.append(sum(b - a for a, b in merged))
                count.append(len(merged))
                digests.append(hashlib.sha256(remaining(raw, merged)).hexdigest())
                if text_out:
                    cut.append(sum(b - a for a, b in of[0]))
                    kept.append(remaining(raw, [inward(raw, a, b) for a, b in of[0]]).decode("utf-8", "ignore"))
            out = [*(batch.column(c) for c in own), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digests, pa.string())]
            if text_out:
                out += [pa.array(cut, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=[*own, *numbers, *["passage_bytes", "kept_text"] * text_out])

    fields = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in own)
    schema = f"{fields}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", passage_bytes bigint, kept_text string" * text_out
    return texts.select(*own, "text", "spans", "whole", "later").mapInArrow(run, schema)


def merge(spans: Iterable[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def remaining(raw: bytes, spans: list) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    parts.append(raw[at:])
    return b"".join(parts)


def inward(raw: bytes, a: int, b: int) -> tuple[int, int]:
    """The span without parts of characters at its ends."""
    while a < b and raw[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def repeated_spans(docs: DataFrame, lengths: Lengths, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(spans, copies) of a table (id, text). spans: id, digest, start, end, earlier for the representative of each text. copies: digest, keeper and count of texts."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            raws = [x.as_py() for x in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.frombuffer(_digest(r), np.int64)[0] for r in raws], pa.int64()), pa.array([len(r) for r in raws], pa.int64())], names=["id", "digest", "n"])

    rows = docs.mapInArrow(digested, "id bigint, digest bigint, n bigint")
    low = F.min(F.coalesce("id", F.lit(-(1 << 63))))
    copies = written(rows.groupBy("digest").agg(low.alias("keeper"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")), "copies")
    # Copies of a text are put together before anything is dealt by gram, so a large group of them is no hot key; a gram that many
    # texts share is counted before its shuffle, and the join's large partitions can be split.
    found = _anchored(docs, lengths.least).groupBy("gram", "digest").agg(low.alias("keeper"), F.max("often").alias("often"))
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"), F.max("often").alias("any")).where("rows > 1 or any").select("gram")
    kept = found.join(grams, "gram").groupBy("keeper", "digest").agg(F.collect_set("gram").alias("grams"))
    both = docs.withColumn("_id", F.coalesce("id", F.lit(-(1 << 63)))).join(kept.select(F.col("keeper").alias("_id"), "grams"), "_id")
    contexts = written(_contexts(both.select("id", "text", "grams"), lengths), "contexts")
    span = ["id", "digest", "start", "end", "earlier"]
    spans = contexts.where("gram is null").select(*span)
    groups = contexts.where("gram is not null").select(*_ROW)
    counts = groups.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    spans = spans.unionAll(_grouped(groups.join(counts.where(F.col("rows") <= group_rows), "gram", "left_semi"), lengths))
    large = counts.where(F.col("rows") > group_rows).select("gram")
    if large.limit(1).count():
        spans = spans.unionAll(_counted(groups.join(large, "gram", "left_semi"), lengths))
    return spans, copies


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, keep: str = "none", passages: int | None = None, group_rows: int = GROUP_ROWS, whole_rows: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 of every row; with whole_rows and keep="first", docs' own columns with the text that is left.

    With passages, keep="none" adds passage_bytes and text: bytes of later copies of strings of that length, and the text without them."""
    lengths = Lengths(min_length if keep == "first" else passages, None if keep == "first" else min_length)
    rows = _texts(docs, key, text)
    spans, copies = repeated_spans(rows, lengths, group_rows)
    by_text = spans.groupBy("digest").agg(F.collect_set(F.struct("start", "end", "earlier")).alias("spans"))
    facts = copies.join(by_text, "digest", "left").where((F.col("copies") > 1) & (F.col("n") >= lengths.least) | F.col("spans").isNotNull())

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            d = [np.frombuffer(_digest(x.as_py()), np.int64)[0] for x in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d, pa.int64())], names=[*batch.schema.names, "own"])

    # Columns go under numbers, so none can clash with those that are added.
    # The text goes once, since `kept_text` takes its place.
    names = [c for c in docs.columns if c != text] if whole_rows else [key]
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    tagged = source.mapInArrow(digested, StructType([*source.schema.fields, StructField("own", LongType())]))
    held = tagged.join(facts, tagged["own"] == facts["digest"], "left")
    many = lambda least: (F.col("copies") > 1) & (F.col("n") >= F.lit(least))
    # Of whole copies the least doc_id is the first; rows of one doc_id with one text count as one document.
    held = held.withColumns({
        "whole": F.coalesce(many(lengths.any), F.lit(False)),
        "later": F.coalesce(many(lengths.first) & (F.coalesce("id", F.lit(-(1 << 63))) != F.col("keeper")), F.lit(False)),
    })
    if not whole_rows:
        out = _cut(held, lengths, ["id"], bool(passages))
        return out.withColumnsRenamed({"id": key, "kept_text": "text"})
    out = _cut(held, lengths, [f"c{i}" for i in range(len(names))], True)
    under = {c: f"c{i}" for i, c in enumerate(names)} | {text: "kept_text"}
    return out.select(*[F.col(under[c]).alias(c) for c in docs.columns])
