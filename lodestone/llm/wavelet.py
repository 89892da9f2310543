"""Token ids in wavelet-matrix files: bit-planes with rank directories that give access, counts and occurrences.

A file holds the ids of a run of documents in ascending doc_id order, each document closed by
an end id. Its parts, little-endian: magic, counts, then doc_id and length of every document,
then for every bit of an id, highest first, the number of zeros, a rank directory (ones before
every 512th bit) and the plane itself. A plane's bits stand in the order left by stably moving
the zeros of the plane above to the front, so an id is read by following its position down.

Files are rows of a table in the shared folder (part, seq, n_tokens, file), as executors share
no local disk; `export` puts them into a plain folder. A null text is an empty one and keeps its
end id; a null doc_id sorts first; rows with equal doc_id stay beside each other, by text. An empty
table gives no files and an empty result; long texts are never cut; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import compress
from pathlib import Path
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import Memo, written
from .bpe import byte_symbols

MAGIC = b"WVMX0001"
BLOCK = 512
#: Tokens after which a shard starts its next file; it bounds a writer's and a reader's memory.
FILE_TOKENS = 1 << 19
#: Bytes of text whose units (see `cuts`) are looked up from one list, and units that are looked up at once; a longer text is a list of its own.
TEXT_BYTES, TABLE_WORDS = 1 << 19, 1 << 16
#: A single document larger than this still gets a file of its own: texts are never cut.
NO_ID = -(1 << 63)


class WaveletMatrix:
    """Succinct sequence of ids: `access`, `rank`, `count`, `select` and `all`."""

    def __init__(self, n: int, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.n, self.planes = n, planes

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n, planes = len(ids), []
        a = ids.astype(np.uint16 if n and ids.max() < 1 << 16 else np.uint32)
        for level in range(int(a.max()).bit_length() - 1 if n else 0, -1, -1):
            bit = ((a >> a.dtype.type(level)).astype(np.uint8) & 1).view(bool)
            packed = np.packbits(bit, bitorder="little")
            padded = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
            padded[: len(packed)] = packed
            per = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            before = np.zeros(len(per), np.uint32)
            np.cumsum(per[:-1], out=before[1:])
            ones = int(per.sum())
            planes.append((n - ones, before, padded))
            moved = np.empty_like(a)  # places are taken, as a mask of such bits is slow to follow
            np.take(a, np.flatnonzero(~bit), out=moved[: n - ones], mode="clip")
            np.take(a, np.flatnonzero(bit), out=moved[n - ones :], mode="clip")
            a = moved
        return cls(n, planes)

    def _ones(self, plane: tuple, i: int) -> int:
        """Ones before position i."""
        _, before, bits = plane
        block = i // BLOCK
        if block >= len(before):
            return self.n - plane[0]
        start = block * BLOCK // 8
        full, rest = (i - block * BLOCK) // 8, i % 8
        ones = int(before[block]) + int(np.bitwise_count(bits[start : start + full]).sum())
        return ones + (int(bits[start + full]) & ((1 << rest) - 1)).bit_count() if rest else ones

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in self.planes:
            bit = int(plane[2][i // 8]) >> (i % 8) & 1
            ones = self._ones(plane, i)
            i = plane[0] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        a, b = 0, end
        for k, plane in enumerate(self.planes):
            x, y = self._ones(plane, a), self._ones(plane, b)
            a, b = (plane[0] + x, plane[0] + y) if symbol >> (len(self.planes) - 1 - k) & 1 else (a - x, b - y)
        return a, b

    def rank(self, symbol: int, end: int) -> int:
        """Occurrences before position end."""
        if symbol >> len(self.planes):
            return 0
        a, b = self._range(symbol, min(end, self.n))
        return b - a

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th occurrence, from 0; -1 if there are fewer."""
        if k >= self.count(symbol):
            return -1
        at = self._range(symbol, self.n)[0] + k
        for level in range(len(self.planes)):
            plane = self.planes[-1 - level]
            one = symbol >> level & 1
            wanted, low, high = at - plane[0] * one, 0, self.n
            while low < high:  # the first position with more than `wanted` such bits up to it
                mid = (low + high) // 2
                ones = self._ones(plane, mid + 1)
                if (ones if one else mid + 1 - ones) > wanted:
                    high = mid
                else:
                    low = mid + 1
            at = low
        return at

    def all(self) -> np.ndarray:
        """Every id in order: the planes' moves undone from the lowest up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for level, (zeros, _, bits) in enumerate(reversed(self.planes)):
            bit = np.unpackbits(bits, count=self.n, bitorder="little").view(bool)
            up = np.empty(self.n, kind)
            up[np.flatnonzero(~bit)] = values[:zeros]
            up[np.flatnonzero(bit)] = values[zeros:] | kind(1 << level)
            values = up
        return values.astype("<u4")


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    m = WaveletMatrix.build(ids)
    head = MAGIC + struct.pack("<QQQ", len(doc_ids), len(ids), len(m.planes))
    body = [np.array([NO_ID if x is None else x for x in doc_ids], "<i8").tobytes(), np.array(lengths, "<u4").tobytes()]
    for zeros, before, bits in m.planes:
        body += [struct.pack("<Q", zeros), before.astype("<u4").tobytes(), bits.tobytes()]
    return head + b"".join(body)


def unpack(file: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    if file[:8] != MAGIC:
        raise ValueError("not a wavelet-matrix file")
    docs, n, levels = struct.unpack_from("<QQQ", file, 8)
    at = 32
    doc_ids = np.frombuffer(file, "<i8", docs, at)
    lengths = np.frombuffer(file, "<u4", docs, at + 8 * docs)
    at, blocks, planes = at + 12 * docs, -(-n // BLOCK), []
    for _ in range(levels):
        (zeros,) = struct.unpack_from("<Q", file, at)
        before = np.frombuffer(file, "<u4", blocks, at + 8)
        bits = np.frombuffer(file, np.uint8, blocks * BLOCK // 8, at + 8 + 4 * blocks)
        planes.append((zeros, before, bits))
        at += 8 + 4 * blocks + blocks * BLOCK // 8
    return [None if x == NO_ID else x for x in doc_ids.tolist()], lengths, WaveletMatrix(n, planes)


class WordTable:
    """Ids of words, as units are called here, of up to 31 bytes, by open addressing in arrays: a key is the word itself, zeros behind it, and its length, so a hit is exact.

    Few places in memory are touched for a word, where a dict of strings touches its slot, its entry, the key and the value. When `most` words are held,
    those that were asked for since they came are kept, and if they are too many, none."""

    WIDTH = 32
    #: For each length, which of a key's bytes belong to the word.
    MASKS = np.frombuffer(b"".join(b"\xff" * n + b"\0" * (32 - n) for n in range(32)), np.uint64).reshape(32, 4)
    #: For each length, the last byte: length + 1, so that no key is all zeros.
    ENDS = np.frombuffer(b"".join(b"\0" * 31 + bytes([n + 1]) for n in range(32)), np.uint64).reshape(32, 4)[:, 3].copy()
    ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]

    def __init__(self, bits: int = 21):
        self.bits, self.most = bits, 1 << (bits - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros((1 << self.bits, 4), np.uint64)
        self.at = np.zeros(1 << self.bits, np.int64)  # 64 times the place in `ids`, and how many
        self.used = np.zeros(1 << self.bits, bool)
        self.ids, self.filled, self.n = np.zeros(1 << 12, np.uint32), 0, 0

    def keys_of(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """text: bytes, with WIDTH more behind; sizes: 31 at most."""
        view = np.ndarray((len(text) - self.WIDTH + 1,), f"V{self.WIDTH}", text, 0, (1,))
        keys = view[starts].view(np.uint64).reshape(-1, 4)
        keys &= self.MASKS.take(sizes, axis=0)
        keys[:, 3] |= self.ENDS.take(sizes)
        return keys

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0] * self.ODD[0]
        for k in (1, 2, 3):
            h += keys[:, k] * self.ODD[k]
        h ^= h >> np.uint64(29)
        h *= self.ODD[4]
        return (h >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not held."""
        slots, mask = self._slots(keys), len(self.keys) - 1
        here, tried, tried_slots, tried_keys = np.empty(len(keys), np.int64), None, slots, keys
        while len(tried_slots):
            held = self.keys.take(tried_slots, axis=0)
            same = held[:, 0] == tried_keys[:, 0]
            for k in (1, 2, 3):
                same &= held[:, k] == tried_keys[:, k]
            found = np.where(same, tried_slots, -1)
            if tried is None:
                here = found
            else:
                here[tried] = found
            on = np.flatnonzero(~same & (held[:, 3] != 0))
            tried = on if tried is None else tried[on]
            tried_slots, tried_keys = (tried_slots[on] + 1) & mask, tried_keys[on]
        return here

    def add(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Keys that are not held, each once; places: what goes into `at`."""
        slots, mask, left = self._slots(keys), len(self.keys) - 1, np.arange(len(keys))
        while len(left):
            s = slots[left]
            free = self.keys[s, 3] == 0
            wish, s = left[free], s[free]
            self.at[s] = wish  # of several keys at a free slot the last one gets it
            got = self.at[s] == wish
            self.keys[s[got]], self.at[s[got]] = keys[wish[got]], places[wish[got]]
            left = np.concatenate([left[~free], wish[~got]])
            slots[left] = (slots[left] + 1) & mask
        self.n += len(keys)

    def put(self, ids: np.ndarray) -> int:
        """Writes ids behind those that are held, and returns their place. They stay if `filled` is moved."""
        if self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        return self.filled

    def of(self, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids at these places, one after the other."""
        ends = np.cumsum(counts)
        return self.ids.take(np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0))

    def room(self, words: int) -> None:
        if self.n + words <= self.most:
            return
        stays = np.flatnonzero(self.used)
        keys, starts, counts = self.keys[stays], self.at[stays] >> 6, self.at[stays] & 63
        ids = self.of(starts, counts)
        self.clear()
        if 2 * len(keys) <= self.most:
            self.filled = self.put(ids) + len(ids)
            self.add(keys, (np.cumsum(counts) - counts) << 6 | counts)


#: Kinds of bytes: parts of letters of one or two bytes, other ASCII signs, blanks, line ends, controls; 0 is all the rest.
LETTER, SIGN, BLANK, LINE_END, CONTROL = 1, 2, 3, 4, 5
KINDS = bytes(BLANK if i == 32 else LINE_END if i == 10 else 0 if i > 127 else CONTROL if i < 32 else LETTER if chr(i).isalpha() else SIGN for i in range(256))
#: For each kind, whether it is part of something that is surely no white space.
PLAIN = np.array([False, True, True, False, False, False])
#: For each code point of two bytes at most, whether it is a letter.
LETTERS = np.array([regex.match(r"\p{L}", chr(i)) is not None for i in range(1 << 11)])


def byte_kinds(raw: bytes) -> np.ndarray:
    """The kind of each byte of texts in UTF-8."""
    kinds, text = np.frombuffer(bytearray(raw.translate(KINDS)), np.uint8), np.frombuffer(raw, np.uint8)
    lead = np.flatnonzero(text[:-1] - np.uint8(0xC2) < 30)
    second = text[lead + 1]
    lead = lead[LETTERS.take((text[lead] & 31).astype(np.int64) << 6 | second & 63) & (second >> 6 == 2)]
    kinds[lead] = kinds[lead + 1] = LETTER
    return kinds


def cuts(kinds: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where units begin: at a text, at a blank, at what is ASCII and no letter behind a letter, and behind a line end between letters or signs.

    The pre-tokenizer cuts there too, and treats both sides as if they stood alone, where no white space is longer than RUNS allows and no added
    token is around: letters end where another kind begins, a blank goes with what follows, and a single line end goes with nothing."""
    cut = kinds == BLANK
    if len(kinds) > 1:
        cut[1:] |= (kinds[:-1] == LETTER) & (kinds[1:] > LETTER)
        behind = np.flatnonzero(kinds[1:-1] == LINE_END) + 2
        cut[behind[PLAIN.take(kinds[behind - 2]) & PLAIN.take(kinds[behind])]] = True
    cut[begins] = True
    return np.flatnonzero(cut)


class ByteLevelEncoder:
    """The tokenizers library behind memos: texts are cut where its own pre-tokenizer always cuts, and each distinct cut is encoded once."""

    #: Places where cutting before every blank would part a run of white space that belongs together.
    RUNS = re.compile(r"\s \s|\s \Z")
    #: The pre-tokenizer's own pattern.
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    #: The settings under which texts are cut so.
    CUTS = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks, self.added = re.compile("|".join(map(re.escape, added))) if added else None, [x.encode() for x in added]
        self.model, self.symbols = self.tokenizer.model, "".join(byte_symbols())
        self.blank = byte_symbols()[32]
        settings = json.loads(self.tokenizer.to_str())
        if settings["normalizer"] or settings["pre_tokenizer"] != self.CUTS or settings["model"]["type"] != "BPE":
            raise ValueError("a tokenizer that cuts its texts in another way")
        self.piece = Memo(self.merged, 60_000)
        self.first = Memo(self.chunk, 20_000)
        self.later = Memo(self.word, 300_000)
        self.table = WordTable()

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, piece: str) -> bytes:
        """One pre-token through the library's model."""
        return array("I", [t.id for t in self.model.tokenize(codecs.charmap_decode(piece.encode(), "strict", self.symbols)[0])]).tobytes()

    def word(self, part: str) -> bytes:
        """What stands between two blanks, with the first of them. Letters, letters and signs, and two such around a line end need no pattern."""
        if part.isalpha():
            if part.isascii():  # only the blank has another symbol than itself
                return array("I", [t.id for t in self.model.tokenize(self.blank + part)]).tobytes()
            return self.merged(" " + part)
        if not (self.marks and self.marks.search(part)):
            stem = part.rstrip(punctuation)
            if stem.isalpha():
                return self.later[stem] + self.piece[part[len(stem) :]]
            before, line_end, after = part.partition("\n")
            if line_end and before and after and before.isprintable() and after.isprintable():
                return self.later[before] + self.piece[line_end] + self.first[after]
        return self.chunk(" " + part)

    def chunk(self, text: str) -> bytes:
        if self.marks and self.marks.search(text):
            return self.library(text)
        return b"".join(map(self.piece.__getitem__, self.PIECES.findall(text)))

    def runs(self, text: str) -> bool:
        """Whether RUNS is anywhere in a text. Where blanks and line ends are the only white space, that takes two blanks, or one before a line end or at the end."""
        if text.replace("\n", "").isprintable() and "  " not in text and " \n" not in text and text[-1:] != " ":
            return False
        return self.RUNS.search(text) is not None

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if self.runs(text):
            return self.chunk(text)
        first, *later = text.split(" ")
        return self.first[first] + b"".join(map(self.later.__getitem__, later))

    def each(self, column: pa.Array) -> Iterator[bytes]:
        """What `encode` gives, for every text of a column, null for an empty one; the units of many texts are looked up at once."""
        if not len(column):
            return
        column = pc.fill_null(column.cast(pa.large_string()), "")
        ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
        a = 0
        while a < len(column):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + TEXT_BYTES, "right")) - 1)
            yield from self._group(column.buffers()[2], ends[a : b + 1])
            a = b

    def _group(self, data: pa.Buffer | None, ends: np.ndarray) -> Iterator[bytes]:
        raw = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data else b""
        begins, ends = ends[:-1] - ends[0], ends[1:] - ends[0]
        kinds = byte_kinds(raw)
        odd = self._odd(raw, kinds, begins, ends)
        starts = cuts(kinds, begins[begins < ends])
        stops = np.append(starts[1:], len(raw))[: len(starts)]
        units = np.diff(np.searchsorted(starts, ends), prepend=0)
        if odd.any():
            kept = np.repeat(~odd, units)
            starts, stops, units = starts[kept], stops[kept], np.where(odd, 0, units)
        text = np.frombuffer(raw + bytes(WordTable.WIDTH), np.uint8)
        found = [self._units(raw, text, kinds, starts[i : i + TABLE_WORDS], stops[i : i + TABLE_WORDS]) for i in range(0, len(starts), TABLE_WORDS)]
        ids = b"".join(x.tobytes() for x, _ in found)
        at = 4 * np.concatenate([[0], *(n for _, n in found)]).cumsum()[np.append(0, units.cumsum())]
        for is_odd, a, b, x, y in zip(odd.tolist(), at[:-1].tolist(), at[1:].tolist(), begins.tolist(), ends.tolist(), strict=True):
            yield self.encode(raw[x:y].decode()) if is_odd else ids[a:b]

    def _odd(self, raw: bytes, kinds: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which texts hold RUNS or an added token, and so are not cut by `cuts`. Few have to be searched: a run needs a blank behind what may be white space."""
        odd, asked = np.zeros(len(ends), bool), np.zeros(len(ends), bool)
        blanks = np.flatnonzero((kinds[1:] == BLANK) & ~PLAIN.take(kinds[:-1])) + 1
        asked[np.searchsorted(ends, blanks, "right")] = True
        for i in np.flatnonzero(asked).tolist():
            odd[i] = self.runs(raw[begins[i] : ends[i]].decode())
        for mark in self.added:
            at = raw.find(mark)
            while at >= 0:  # found across two texts it makes one of them odd, which changes no id
                i = int(np.searchsorted(ends, at, "right"))
                odd[i] = True
                at = raw.find(mark, max(at + 1, int(ends[i])))
        return odd

    def _new(self, letters: list[bytes], others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units in one array, and how many each has; letters: units of one pre-token, letters with or without a blank before them."""
        flat, counts, tokenize = array("I"), [], self.model.tokenize
        for w in codecs.charmap_decode(b"\n".join(letters), "strict", self.symbols)[0].split(self.symbols[10]) if letters else ():
            ids = [t.id for t in tokenize(w)]
            flat.extend(ids)
            counts.append(len(ids))
        for w in others:
            ids = self.chunk(w.decode())
            flat.frombytes(ids)
            counts.append(len(ids) // 4)
        return np.frombuffer(flat, np.uint32) if flat else np.empty(0, np.uint32), np.array(counts, np.int64)

    def _units(self, raw: bytes, text: np.ndarray, kinds: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, and how many each has."""
        table, sizes = self.table, stops - starts
        table.room(len(starts))
        short = sizes < WordTable.WIDTH
        keys = table.keys_of(text, starts, np.where(short, sizes, 0))
        slots = np.where(short, table.find(keys), -1)
        table.used[slots[slots >= 0]] = True
        missed = np.flatnonzero((slots < 0) & short)
        if len(missed):
            new = dict(zip((raw[a:b] for a, b in zip(starts[missed].tolist(), stops[missed].tolist(), strict=True)), missed.tolist(), strict=True))
            which = np.array(list(new.values()))
            blank, signs = kinds[starts[which]] == BLANK, np.append(0, (kinds != LETTER).cumsum(dtype=np.int32))
            plain = (signs[stops[which]] - signs[starts[which]] == blank) & (sizes[which] > blank)
            flat, counts = self._new(list(compress(new, plain.tolist())), list(compress(new, (~plain).tolist())))
            at = table.put(flat)
            table.filled = at + len(flat)
            table.add(keys[np.concatenate([which[plain], which[~plain]])], (at + counts.cumsum() - counts) << 6 | counts)
            slots[missed] = table.find(keys[missed])
        places = table.at.take(slots, mode="wrap")
        begin, count = places >> 6, places & 63
        long = np.flatnonzero(~short)
        if len(long):
            got = [self.first[raw[a:b].decode()] for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True)]
            count[long] = [len(x) // 4 for x in got]
            begin[long] = table.put(np.frombuffer(b"".join(got), "<u4")) + count[long].cumsum() - count[long]
        return table.of(begin, count), count


ENCODERS = Memo(ByteLevelEncoder, 4)


def write_files(docs: DataFrame, tokenizer: str, end_id: int = 0, text: str = "text", key: str = "doc_id", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encodes all texts and writes the files; returns their table. One shuffle: by ranges of doc_id, so that parts follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, part = ENCODERS[tokenizer], np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        seq, doc_ids, lengths, ids, size = 0, [], [], [], 0

        def file() -> pa.RecordBatch:
            blob = pack(doc_ids, lengths, np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_tokens": pa.array([size], pa.int64()), "file": pa.array([blob], pa.binary())})

        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), encoder.each(batch.column(1)), strict=True):
                if size >= file_tokens:
                    yield file()
                    seq, doc_ids, lengths, ids, size = seq + 1, [], [], [], 0
                got = x + end
                doc_ids.append(k)
                lengths.append(len(got) // 4)
                ids.append(got)
                size += len(got) // 4
        if doc_ids:
            yield file()

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    ordered = rows.repartitionByRange(key).sortWithinPartitions(F.col(key).asc_nulls_first(), text)
    return written(ordered.mapInArrow(run, "part int, seq int, n_tokens bigint, file binary"), "wavelet-files")


def read_files(files: DataFrame, key: str = "doc_id", tokens: bool = False) -> DataFrame:
    """Per document, out of the files alone: start, n_tokens and ids_crc32 (and the ids). Starts come from sums of files, then of parts."""

    names = ["part", "seq", key, "at", "n_tokens", "ids_crc32", *["ids"] * tokens]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                doc_ids, lengths, matrix = unpack(blob.as_py())
                ids, ends = matrix.all(), np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                cuts = list(zip(starts.tolist(), ends.tolist(), strict=True))
                place = [pa.repeat(x, len(cuts)) for x in (part, seq)]
                out = [*place, pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(lengths.astype(np.int64)), pa.array([zlib.crc32(ids[a:b]) for a, b in cuts], pa.int64())]
                if tokens:
                    out.append(pa.array([ids[a:b].tolist() for a, b in cuts], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"part int, seq int, {key} bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * tokens
    rows = files.select("part", "seq", "file").mapInArrow(run, schema)
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    # One row for each part, which is each task of the writer: a bounded single-task window.
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    bases = files.select("part", "seq", F.coalesce(before, F.lit(0)).alias("file_start")).join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("file_start")).alias("base"))
    # The files' bytes stay where they are read; only what was read out of them meets the sums.
    return rows.join(bases, ["part", "seq"]).select(key, (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * tokens)


def export(files: DataFrame, folder: str) -> int:
    """Puts the files into a plain folder of the driver, one at a time; returns how many."""
    n = 0
    for row in files.select("part", "seq", "file").toLocalIterator():
        Path(folder, f"shard-{row.part:05d}-{row.seq:05d}.wvm").write_bytes(bytes(row.file))
        n += 1
    return n
