"""BPE encoding by backtracking over Aho-Corasick matches, and decoding by an offset table.

The encoder never replays merges. One Aho-Corasick pass over a piece finds, for each
start, the longest vocabulary token there; a table has the next shorter ones. Tokens are then laid from left to right, longest
first, each one checked against its left neighbour in a pair-compatibility table; when no
token fits, the last one is taken back, and the position it led to is marked dead. As a
text's prefix has one merge-exact encoding only, no position is entered twice, so time is
linear in the piece. The table says of two tokens whether merging their concatenation
gives just these two; its entries are worked out on first use.

Null, empty or blank texts have no ids and decode to the empty text. Repeated rows are
encoded alike. Extra columns are ignored; doc_id is passed through, null included.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Memo

#: Distance between a symbol and the same symbol at a word's end.
WORD_END = 0x1000
NEVER = 1 << 40
#: Marks that, alone behind letters, are a piece of their own.
STOPS = (b".", b",", b"!", b"?", b";", b":")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte, by the rule of byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE model with word ends, read from a tokenizer's JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        ids, merges = stored["model"]["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in stored["model"]["merges"]]
        suffix = stored["model"].get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.added_bytes = [x.encode() for x in self.added]
        pattern = next(p["pattern"]["Regex"] for p in stored["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern)
        self.spaces = regex.compile(r"\s+")
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        symbols = byte_symbols()
        self.symbol, self.last_symbol = symbols, [chr(ord(s) + WORD_END) for s in symbols]
        text_of = {s: s for s in symbols} | {s + suffix: chr(ord(s) + WORD_END) for s in symbols}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for k, (a, b) in enumerate(merges):
            text_of[a + b] = text_of[a] + text_of[b]
            token, pair = ids[a + b], (ids[a], ids[b])
            self.parts.setdefault(token, pair)
            self.rank.setdefault(token, k)
            self.joined.setdefault(pair, k)
        self.compatible = Memo(self._compatible, 2_000_000)
        own: set[int] = set()
        self.automaton = ahocorasick.Automaton()
        for token_text, s in text_of.items():
            token = ids.get(token_text)
            if token is None:
                continue
            if token in self.parts:
                a, b = self.parts[token]
                if not (self._own(a, own) and self._own(b, own) and not self._crossed(a, b, below=self.rank[token])):
                    continue
            own.add(token)
            self.automaton.add_word(s, (token, len(s)))
        self.automaton.make_automaton()
        #: For each token the next shorter one that it begins with.
        longest: dict[str, tuple[int, int] | None] = {"": None}
        self.shorter: dict[int, tuple[int, int] | None] = {}
        self.length: dict[int, int] = {}
        for s, (token, n) in sorted(self.automaton.items(), key=lambda x: x[1][1]):
            for i in range(1, n):
                if s[:i] not in longest:
                    longest[s[:i]] = longest[s[: i - 1]]
            self.shorter[token], self.length[token] = longest[s[:-1]], n
            longest[s] = (token, n)
        size = max([*ids.values(), *self.added.values()]) + 1
        names = [b""] * size
        for name, i in [*ids.items(), *self.added.items()]:
            names[i] = name.encode()
        #: Decoding: all token names in one block, and where each begins.
        self.block = b"".join(names)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in names])]).astype(np.int64)
        self.name_of = [self.block[a:b] for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True)]
        self.ids_of_piece = Memo(lambda piece: array("I", self.encode_piece(piece)).tobytes(), 350_000)
        self.ids_of = Memo(self._ids_of_chunk, 500_000)

    def _own(self, token: int, own: set[int]) -> bool:
        return token not in self.parts or token in own

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at a token's inner edge with the rank of the merge that ends each, whole token first."""
        out, ends = [], NEVER
        while True:
            out.append((token, ends))
            if token not in self.parts:
                return out
            ends, token = self.rank[token], self.parts[token][side]

    def _crossed(self, a: int, b: int, below: int) -> bool:
        """Does a merge ranked under `below` join a's right edge with b's left edge while both stand? At equal rank the left pair goes first."""
        right = self._spine(b, 0)
        for x, x_ends in self._spine(a, 1):
            for y, y_ends in right:
                k = self.joined.get((x, y), NEVER)
                if k < below and k < x_ends and k <= y_ends:
                    return True
        return False

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return not self._crossed(*pair, below=NEVER)

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one pre-token."""
        raw = piece.encode()
        s = "".join(map(self.symbol.__getitem__, raw[:-1])) + self.last_symbol[raw[-1]]
        if s in self.automaton:
            return [self.automaton.get(s)[0]]
        dead: set[int] = set()
        path: list[int] = []
        size, at, shorter, fits = len(s), 0, self.shorter, self.compatible
        longest: list[tuple[int, int] | None] = [None] * size
        for end, found in self.automaton.iter(s):  # by rising end: the last match of a start is its longest
            longest[end + 1 - found[1]] = found
        found = longest[0]
        while True:
            while found and ((at + found[1]) in dead or path and not fits[path[-1], found[0]]):
                found = shorter[found[0]]
            if found:
                path.append(found[0])
                at += found[1]
                if at == size:
                    return path
                found = longest[at]
            elif not path:
                raise ValueError(f"the vocabulary can't spell {piece!r}")
            else:
                dead.add(at)
                last = path.pop()
                at -= self.length[last]
                found = shorter[last]

    def _ids_of_chunk(self, chunk: bytes) -> bytes:
        """Ids, packed, of a run without ASCII white space. Pieces never cross that, and neither does normalisation."""
        if chunk.isalpha():  # ASCII letters only: one piece, lower-cased
            return self.ids_of_piece[chunk.lower().decode()]
        if chunk[-1:] in STOPS and chunk[:-1].isalpha():
            return self.ids_of[chunk[:-1]] + self.ids_of_piece[chunk[-1:].decode()]
        text = chunk.decode("utf-8", "replace")
        if not any(x in chunk for x in self.added_bytes):
            return b"".join(map(self.ids_of_piece.__getitem__, self._pieces(text)))
        out = []
        for part in self.split_added.split(text) if self.split_added else [text]:
            if part in self.added:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                out += map(self.ids_of_piece.__getitem__, self._pieces(part))
        return b"".join(out)

    def _pieces(self, text: str) -> list[str]:
        """Normalised and cut as the tokenizer's own steps do; lower case goes character by character there."""
        if text.isascii():
            return self.pieces.findall(text.lower())
        text = self.spaces.sub(" ", unicodedata.normalize("NFC", text))
        return self.pieces.findall("".join(map(str.lower, text)))

    def encode(self, text: bytes) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids_of.__getitem__, text.split())), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """As a tokenizer without a decoder does: token names with blanks between, special ones included."""
        return b" ".join(map(self.name_of.__getitem__, ids.tolist()))


VOCABULARIES = Memo(Vocabulary, 4)


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id", full: bool = False) -> DataFrame:
    """key, n_tokens, ids_sha256 and decoded_sha256 of every row; with full, the ids and the decoded text too. No shuffle: one pass in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = VOCABULARIES[vocabulary]
        for batch in batches:
            n, a, b, ids_out, text_out = [], [], [], [], []
            for x in batch.column(1).cast(pa.binary()):
                ids = v.encode(x.as_py() or b"")
                back = v.decode(ids)
                n.append(len(ids))
                a.append(hashlib.sha256(ids.tobytes()).hexdigest())
                b.append(hashlib.sha256(back).hexdigest())
                if full:
                    ids_out.append(ids)
                    text_out.append(back.decode())
            out = [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                out += [pa.array([x.tolist() for x in ids_out], pa.list_(pa.int64())), pa.array(text_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"{key} bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<bigint>, decoded string" * full
    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(run, schema)
