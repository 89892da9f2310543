"""Each operator against a brute-force version, a round trip or held-out labels; edge cases for all of them."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestone.llm import bpe, factors, gif, jaccard, mixing, ordinal, rules, sharding, warc, wavelet
from lodestone.llm._common import components
from lodestone.llm.queries import tokenizer

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(400)]


def frame(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def edge(spark):
    """Null keys and texts, empty and blank texts, repeated rows, a long text, and columns whose names the operators use themselves."""
    long = " ".join(random.Random(1).choice(WORDS) for _ in range(30_000))
    rows = [(None, "a b c d e f", "s"), (1, None, "s"), (2, "", None), (3, " \n\t", "s"), (4, "one", "t"), (5, "same text here now again " * 120, "t"), (5, "same text here now again " * 120, "t"), (6, "same text here now again " * 120, "t"), (7, long, "t"), (8, "é😀" * 300, "t"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for name in ("id", "n", "digest", "keys", "bits", "group", "component", "shard", "slot", "copy", "n_copies", "kept", "score", "n_words", "spans", "whole", "c0", "own", "_row", "_words", "start", "size", "law", "part", "label"):
        df = df.withColumn(name, F.lit("x"))
    return df


OPS = {
    "ordinal": lambda s, d: ordinal.score(d, ordinal.train(d, s.createDataFrame([(5, 2), (5, 1), (4, 0), (None, 2), (99, 1)], "doc_id bigint, grade int"))),
    "jaccard": lambda s, d: jaccard.similar(d)[0],
    "factors": lambda s, d: factors.deduplicated(d),
    "factors_first": lambda s, d: factors.deduplicated(d, keep="first", whole_rows=True),
    "sharding": lambda s, d: sharding.shard_documents(d, sharding.tree_of(16)),
    "rules": lambda s, d: rules.judged(d, rules.ratio_table(d, s.createDataFrame([(5,), (None,)], "doc_id bigint"))),
    "wavelet": lambda s, d: wavelet.read_files(wavelet.write_files(d, tokenizer("byte_bpe_50k.json"))),
    "gif": lambda s, d: gif.features(gif.stored(d)),
    "warc": lambda s, d: warc.read_archives(warc.write_archives(d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), F.col("source").alias("url"), "id", "digest"))),
    "bpe": lambda s, d: bpe.encode_decode(d, tokenizer("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", OPS)
def test_edges_and_empty_table(spark, name):
    df = edge(spark)
    assert OPS[name](spark, df).count() == 11
    assert OPS[name](spark, df.limit(0)).count() == 0


def test_mixing_edges(spark):
    df = edge(spark)
    out = mixing.mixed(df, weight=F.sqrt)
    assert out.columns == df.columns
    assert out.where("doc_id = 5").count() % 2 == 0
    assert mixing.mixed(df.limit(0), weight=F.sqrt).count() == 0
    assert {r.copy for r in mixing.replicate(df, weight=F.sqrt).collect()} <= set(range(20))


def near(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(WORDS)
    return out


def test_jaccard_against_brute_force(spark):
    rng = random.Random(3)
    base = [[rng.choice(WORDS) for _ in range(rng.choice([4, 5, 7, 30, 120]))] for _ in range(40)]
    texts = [" ".join(near(rng, b, rng.choice([0, 0, 1, 2, 3]))) for b in base for _ in range(4)] + ["", "A b", "a B", "hot " * 9] + ["hot line of words in all of them " + " ".join(rng.choice(WORDS) for _ in range(8)) for _ in range(60)]
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := t.lower().split()) else frozenset() for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    want = {(i, len(s), root(i)) for i, s in enumerate(sets)}
    for tokens in (jaccard.BLOCK_TOKENS, 100):  # the second cuts every component into blocks
        members, links = jaccard.similar(frame(spark, texts), block_tokens=tokens)
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in members.collect()} == want
        for r in links.collect():
            assert 100 * len(sets[r.a] & sets[r.b]) >= 80 * len(sets[r.a] | sets[r.b])


def test_jaccard_of_repeated_rows_and_of_one_doc_id_on_two_texts(spark):
    rng = random.Random(8)
    base = [[rng.choice(WORDS) for _ in range(60)] for _ in range(12)]
    rows = [(2 * k + i, " ".join(near(rng, b, i))) for k, b in enumerate(base) for i in (0, 1)]
    a, b, c = ([rng.choice(WORDS) for _ in range(60)] for _ in range(3))
    # 40 and 41 are linked through 50 only; 42 equals one text of 50; 51 has an empty text too; 52 has two near texts.
    rows += [(40, " ".join(near(rng, a, 1))), (50, " ".join(a)), (50, " ".join(b)), (41, " ".join(near(rng, b, 1))), (42, " ".join(b))]
    rows += [(51, ""), (51, " ".join(c)), (43, " ".join(c)), (52, " ".join(base[0])), (52, " ".join(near(rng, base[0], 1)))]
    sets = [(i, frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if (w := t.split()) else frozenset()) for i, t in rows]
    component = {i: i for i, _ in rows}
    for _ in rows:
        for i, s in sets:
            for j, t in sets:
                if i != j and s & t and 100 * len(s & t) >= 80 * len(s | t):
                    component[i] = component[j] = min(component[i], component[j])
    assert len({component[2 * k] for k in range(12)}) == 12 and component[41] == 40 == component[42] and component[51] == 43 and component[52] == 0
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for times in (1, 2, 3):
        table = docs
        for _ in range(times - 1):
            table = table.unionAll(docs)
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar(table)[0].collect())
        assert got == Counter({k: n * times for k, n in Counter((i, len(s), component[i]) for i, s in sets).items()})


def test_jaccard_of_null_doc_ids(spark):
    rng = random.Random(9)
    a, b, c, d, e = ([rng.choice(WORDS) for _ in range(60)] for _ in range(5))
    far, farther = a[:-6], a[6:]  # each links with a, but not with the other
    rows = [(8, far), (None, a), (7, farther), (None, a), (-5, b), (None, b), (None, near(rng, b, 1)), (None, c), (None, c[:-1]), (None, d), (9, e), (9, c[1:] + d), (None, e[:-1]), (None, [])]
    rows += [(None, ["one"]), (3, ["one"]), (None, ["two"])]
    want = [(8, 50, 7), (None, 56, 7), (7, 50, 7), (None, 56, 7), (-5, 56, -5), (None, 56, -5), (None, 0, -5), (None, 56, None), (None, 55, None), (None, 56, None), (9, 56, 9), (9, 115, 9), (None, 55, 9), (None, 0, None), (None, 1, 3), (3, 1, 3), (None, 1, None)]
    want[6] = (None, len({tuple(rows[6][1][i : i + 5]) for i in range(56)}), -5)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    for table, times in ((docs, 1), (docs.unionAll(docs), 2)):
        for tokens in (jaccard.BLOCK_TOKENS, 100):
            got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar(table, block_tokens=tokens)[0].collect())
            assert got == Counter({k: n * times for k, n in Counter(want).items()})


def test_signature_tree_loses_no_pair():
    rng = np.random.default_rng(5)
    sets = []
    for n in (3, 20, 100, 700):
        for _ in range(12):
            s = rng.integers(0, 1 << 63, n, np.uint64)
            sets += [np.unique(s), np.unique(np.concatenate([s[: n - n // 12], rng.integers(0, 1 << 63, n // 12, np.uint64)]))]
    tree = jaccard.SignatureTree(np.array([len(s) for s in sets]), [jaccard.bitmap(s) for s in sets])
    found = {tuple(sorted((int(a), int(b)))) for i, j in tree.pairs() for a, b in zip(i, j, strict=True)}
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard.linked(sets[i], sets[j])}
    assert linked and linked <= found and len(found) < len(sets) ** 2 / 8


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (200, 101), (7, 7)] + [(500, i) for i in range(501, 540)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in (100, 101, 200)} | {i: 500 for i in range(500, 540)}


def brute_factors(texts, n, first):
    raws, seen, out = [t.encode() for t in texts], set(), []
    count = Counter(r[p : p + n] for r in raws for p in range(len(r) - n + 1))
    for r in raws:
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - n + 1):
            w = r[p : p + n]
            if count[w] > 1 and (not first or w in seen):
                gone[p : p + n] = True
            seen.add(w)
        out.append((len(r), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


def passage_texts():
    rng = random.Random(9)
    passage = ["".join(rng.choice("abcé ") for _ in range(n)) for n in (39, 40, 41, 90, 300)]
    texts = ["".join(rng.choice([*passage, "".join(rng.choice("xyz") for _ in range(rng.randrange(30)))]) for _ in range(rng.randrange(6))) for _ in range(60)]
    return [*texts, "a" * 200, "ab" * 100, texts[3], texts[3], texts[5], "", "short"]


@pytest.mark.parametrize(("first", "group_rows"), [(False, 2_000), (True, 2_000), (False, 2), (True, 2), (False, 8), (True, 8)])
def test_factors_against_brute_force(spark, first, group_rows):
    texts = passage_texts()
    got = factors.deduplicated(frame(spark, texts), min_length=40, keep="first" if first else "none", group_rows=group_rows).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == brute_factors(texts, 40, first)


@pytest.mark.parametrize("group_rows", [2_000, 3])
def test_passages_beside_longer_strings(spark, group_rows):
    """Two lengths from one pass: strings of 70 bytes removed everywhere, passages of 40 bytes but for the first."""
    texts = passage_texts()
    got = factors.deduplicated(frame(spark, texts), min_length=70, passages=40, group_rows=group_rows).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == brute_factors(texts, 70, False)
    assert [r.passage_bytes for r in got] == [n for _, n, _, _ in brute_factors(texts, 40, True)]
    alone = factors.deduplicated(frame(spark, texts), min_length=40, keep="first", whole_rows=True).orderBy("doc_id").collect()
    assert [r.text for r in got] == [r.text for r in alone]


def test_repeated_rows_are_one_document(spark):
    """The first of copies keeps its text, however often its row is there; a later copy loses it."""
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(600))
    rows = spark.createDataFrame([(1, text), (1, text), (2, text), (3, "x" + text[:450])], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_removed) for r in factors.deduplicated(rows, keep="first").collect())
    assert got == [(1, 0), (1, 0), (2, 600), (3, 450)]


def test_longest_factors_of_rows(monkeypatch):
    """The LPF of every suffix that starts at a branching of the contexts, against all pairs of rows."""
    monkeypatch.setattr(factors, "NODE_ROWS", 30)
    rng = random.Random(6)
    agree = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    for size in (2, 3, 9, 40):
        group = np.repeat([1, 2, 3], size)
        rows = [tuple("".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode() for _ in range(2)) for _ in group]
        parts = factors.longest_factors(group, [a for a, _ in rows], [b for _, b in rows], (9, 9))
        got = {(r, d): (p, o) for part in parts for r, d, p, o in zip(*(x.tolist() for x in part), strict=True)}
        want = {}
        for i, (a, b) in enumerate(rows):
            others = [(j, agree(a, x), agree(b, y)) for j, (x, y) in enumerate(rows) if j != i and group[j] == group[i]]
            for d in {n for _, n, _ in others}:
                fits = [(j, m) for j, n, m in others if n >= d]
                want[i, d] = (max([-1, *(m for j, m in fits if j < i)]), max(m for _, m in fits))
        assert got == want


def test_sharding_law(spark):
    docs = frame(spark, [f"text {i}" for i in range(3000)])
    rows = sharding.shard_documents(docs, sharding.tree_of(16)).collect()
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and 100 < sum(r.grown_shard == 16 for r in rows) < 260
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append((r.doc_id, r.slot))
        assert (r.size, r.text_crc32) == (len(f"text {r.doc_id}") + 1, zlib.crc32(f"text {r.doc_id}".encode()))
    assert sorted(by) == list(range(16)) and all(sorted(v) == [(d, i) for i, (d, _) in enumerate(sorted(v))] and 120 < len(v) < 260 for v in by.values())
    twice = sharding.grown(sharding.grown(sharding.tree_of(16)))
    moved = sharding.placed(sharding.placed(docs, sharding.tree_of(17), "doc_id", "a"), twice, "doc_id", "b").collect()
    assert all(r.b in (r.a, 17) for r in moved)
    heavier = [sharding.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 5 else 1.0) for s in sharding.tree_of(16)]
    rows = sharding.placed(sharding.placed(docs, sharding.tree_of(16), "doc_id", "a"), heavier, "doc_id", "b").collect()
    region = {s.shard: s.region for s in heavier}
    assert all(r.a == r.b or region[r.b] == region[5] for r in rows)  # movement only into the subtree that grew


def test_slots_of_extreme_and_outlying_keys(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 50)
    far = [-(1 << 63), -(1 << 62) - 5, (1 << 62) + 5, (1 << 63) - 1, None, None, 7, 7]
    docs = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate([*range(3000), *far])], "doc_id bigint, text string")
    rows = sharding.shard_documents(docs, sharding.tree_of(16)).collect()
    assert len(rows) == 3008
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append((r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size, r.slot))
    for v in by.values():
        assert [x[-1] for x in sorted(v)] == list(range(len(v)))
    bounds = [3, 9, 9, 40]
    got = spark.range(50).select("id", sharding.below(F.col("id"), bounds).alias("n")).collect()
    assert all(r.n == sum(b < r.id for b in bounds) for r in got)


def test_poisson(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 100 == 1, "c").otherwise("b").alias("source"))
    rows = mixing.replicate(docs, {"a": 1.0, "b": 1.0, "c": 98.0}).collect()
    n = Counter(r.source for r in rows)
    assert abs(n["a"] - 60) < 40 and abs(n["b"] - 60) < 40 and abs(n["c"] - 5880) < 320  # rates of 0.03, 0.02 and some 147
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)
    one = mixing.replicate(docs.withColumn("source", F.lit("x")), F.sqrt).groupBy("doc_id").count().groupBy("count").count().collect()
    share = {r[0]: r[1] / 6000 for r in one}
    assert abs(share[1] - 0.368) < 0.03 and abs(share[2] - 0.184) < 0.03 and abs(share[3] - 0.061) < 0.02
    old, mixing.BROADCAST_SOURCES = mixing.BROADCAST_SOURCES, 1
    try:
        assert sorted(mixing.replicate(docs, {"a": 1.0, "b": 1.0, "c": 98.0}).collect()) == sorted(rows)
    finally:
        mixing.BROADCAST_SOURCES = old


def test_rules_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(WORDS[:60]) for _ in range(rng.randrange(60))) + rng.choice(["", "\nx y\nx y\n \n", " #*| <é> ", "\x1c z"]) for _ in range(80)] + ["a b c d e f g h " * 6, None, "", "q " * 40]
    docs = frame(spark, texts)
    trusted = list(range(0, 80, 3))
    got = rules.judged(docs, rules.ratio_table(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id bigint"))).orderBy("doc_id").collect()
    words = [[w for w in (t or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w] for t in texts]
    h = lambda *w: _chain(w) >> (64 - rules.BUCKET_BITS)

    def _chain(w):
        one = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in w]
        if len(one) == 1:
            return one[0]
        first = xxhash.xxh64_intdigest((one[0]).to_bytes(8, "little"), seed=42)
        return xxhash.xxh64_intdigest((one[1]).to_bytes(8, "little"), seed=first)

    grams = [[h(x) for x in w] + [h(a, b) for a, b in zip(w, w[1:], strict=False)] for w in words]
    raw, target = Counter(g for d in grams for g in d), Counter(g for i in trusted for g in grams[i])
    R, T = sum(raw.values()), sum(target.values())
    for r, w, g, t in zip(got, words, grams, texts, strict=True):
        at = defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i : i + 8])].append(i)
        repeat = len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)})
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(w) < 20 or 100 * repeat > 30 * len(w))
        want = sum(np.log((target[x] + 2) / (max(raw[x] - 1, 0) * T / R + 2)) for x in g) / len(g) if g else 0.0
        assert abs(r.score - want) < 1e-5 and r.kept == (not r.base_failed and r.score >= rules.THRESHOLD)
    assert [r.doc_id for r in rules.accepted(docs, rules.ratio_table(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id bigint"))).orderBy("doc_id").collect()] == [r.doc_id for r in got if r.kept]


ODD = "abcdeABCΣσßéÉ'ſsdtmlvre    \n\n\t \u0085\x1c　İǅ́̈٣12ªº!?.,<|>½中😀👍🏽‍\x00#"


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) + ("<|endoftext|> x" if i % 9 == 0 else "") for i in range(n)]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    t.no_truncation(), t.no_padding()
    texts = [*odd_texts(1500, 1), "a" * 3000, "supercalifragilistic" * 200, "don't we'LL", ""]
    rows = bpe.encode_decode(frame(spark, texts), tokenizer("word_bpe_49k.json"), full=True).orderBy("doc_id").collect()
    for r, x in zip(rows, texts, strict=True):
        ids = t.encode(x, add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == t.decode(ids, skip_special_tokens=False)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_bpe_scans_a_long_piece_once():
    v = bpe.Vocabulary(tokenizer("word_bpe_49k.json"))

    class Counted:
        """The automaton, and how many characters it was handed."""

        def __init__(self, automaton):
            self.automaton, self.seen = automaton, 0

        def __contains__(self, s):
            return s in self.automaton

        def __getattr__(self, name):
            def call(s, *rest):
                self.seen += len(s)
                return getattr(self.automaton, name)(s, *rest)

            return call

    piece = "".join(random.Random(4).choice("etaoinshrdlu") for _ in range(5000))
    want = v.encode_piece(piece)
    assert "".join(v.name_of[i].decode() for i in want).removesuffix("</w>") == piece
    v.automaton = Counted(v.automaton)
    assert v.encode_piece(piece) == want and v.automaton.seen <= 2 * len(piece)


def test_wavelet_files(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    texts = [*odd_texts(800, 2), None, "  a   b  ", "x" * 5000]
    files = wavelet.write_files(frame(spark, texts), tokenizer("byte_bpe_50k.json"), file_tokens=2000)
    rows, start = wavelet.read_files(files, tokens=True).orderBy("doc_id").collect(), 0
    for r, x in zip(rows, texts, strict=True):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids, r.ids_crc32) == (start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert wavelet.export(files, str(tmp_path)) == files.count() > 3
    ids = np.random.default_rng(1).integers(0, 37, 3000)
    m = wavelet.WaveletMatrix.build(ids)
    assert (m.all() == ids).all() and [m.access(i) for i in range(0, 3000, 91)] == ids[::91].tolist()
    for s in range(40):
        at = np.flatnonzero(ids == s)
        assert m.count(s) == len(at) and m.rank(s, 1700) == (at < 1700).sum() and m.select(s, len(at)) == -1
        assert [m.select(s, k) for k in range(0, len(at), 17)] == at[::17].tolist()
    assert wavelet.WaveletMatrix.build(np.empty(0, np.int64)).all().tolist() == []


def lzw(data, min_size):
    """A plain LZW coder that lets its table and its codes grow."""
    clear, codes = 1 << min_size, []
    table, width, word = {bytes([i]): i for i in range(clear)}, min_size + 1, b""
    codes.append((clear, width))
    for b in data:
        nxt = word + bytes([b])
        if nxt in table:
            word = nxt
            continue
        codes.append((table[word], width))
        if len(table) + 2 < 4096:
            table[nxt] = len(table) + 2
            if len(table) + 2 > 1 << width and width < 12:
                width += 1
        word = bytes([b])
    codes += [(table[word], width)] if word else []
    codes.append((clear + 1, width))
    value = bits = 0
    for c, w in codes:
        value |= c << bits
        bits += w
    return value.to_bytes(-(-bits // 8), "little")


def test_gif_lzw():
    rng = np.random.default_rng(2)
    for data, size in ((b"abab" * 900, 8), (rng.integers(0, 4, 3000, np.uint8).tobytes(), 2), (rng.integers(0, 256, 9000, np.uint8).tobytes(), 8), (b"\x01" * 5000, 2)):
        assert gif.lzw_decode(lzw(data, size), size, len(data)).tobytes() == data
    for bad in (b"\x00", gif.lzw_encode([b"abc" * 400])[0][:-4]):
        with pytest.raises(ValueError, match="ends early|before its entry"):
            gif.lzw_decode(bad, 8, 1200)
    text, noise = b"the same words and the same words again, " * 90, rng.integers(0, 256, 30_000, np.uint8).tobytes()
    data = [text[: gif.LIFE], b"", b"x", b"a" * gif.LIFE, noise[: gif.LIFE], noise, text + noise + text, text * 9]
    streams = gif.lzw_encode(data)
    assert streams[:5] == [lzw(x, 8) for x in data[:5]] == gif.lzw_encode(data[:5]) == [gif.lzw_encode([x])[0] for x in data[:5]]
    assert [gif.lzw_decode(x, 8, len(d)).tobytes() for x, d in zip(streams, data, strict=True)] == data
    assert len(streams[0]) < gif.LIFE / 4
    for n in (576, 254 * 24, 36_864 + 576):
        payload = rng.integers(0, 256, n, np.uint8).tobytes()
        _, _, frames = gif.decode(gif.encode([payload])[0])
        assert b"".join(f.indices.tobytes() for f in frames) == payload and (frames[0].canvas[..., 0].ravel()[: len(frames[0].indices)] == frames[0].indices).all()


def test_gif_disposal_and_transparency():
    red, green = bytes([255, 0, 0]), bytes([0, 255, 0])
    head = b"GIF89a" + bytes([4, 0, 4, 0, 0x80, 0, 0]) + red + green

    def picture(data, x, y, w, h, disposal, transparent=None, flags=0, local=b""):
        control = bytes([0x21, 0xF9, 4, disposal << 2 | (transparent is not None), 5, 0, transparent or 0, 0])
        place = b"\x2c" + b"".join(v.to_bytes(2, "little") for v in (x, y, w, h)) + bytes([flags])
        return control + place + local + b"\x02" + gif.sub_blocks(lzw(data, 2))

    file = head + picture(bytes(16), 0, 0, 4, 4, 1) + picture(bytes([1, 0, 0, 1]), 0, 0, 2, 2, 3, transparent=0) + picture(bytes([1] * 4), 2, 2, 2, 2, 2) + picture(bytes([0, 0, 1, 1]), 0, 0, 1, 4, 0, flags=0xC0, local=green + red) + b"\x3b"
    _, _, frames = gif.decode(file)
    colour = lambda f, y, x: "rg.."[0 if f.canvas[y, x, 3] and f.canvas[y, x, 0] else 1 if f.canvas[y, x, 3] else 2]
    assert [colour(frames[0], 0, 0), colour(frames[1], 0, 0), colour(frames[1], 0, 1), colour(frames[1], 1, 1)] == ["r", "g", "r", "g"]
    assert colour(frames[2], 0, 0) == "r" and colour(frames[2], 3, 3) == "g"  # the second frame was undone
    assert colour(frames[3], 3, 3) == "."  # the third was cleared
    assert [colour(frames[3], y, 0) for y in range(4)] == ["g", "r", "g", "r"]  # interlaced, with a palette of its own
    assert [f.start_ms for f in frames] == [0, 50, 100, 150] and sum(gif.histogram(frames[0].canvas)) == 48


def test_gif_frames_table(spark):
    rows = gif.frames_of(gif.stored(frame(spark, ["abc", "x" * 40_000]))).orderBy("doc_id", "frame").collect()
    assert [(r.doc_id, r.frame, r.start_ms, r.height) for r in rows] == [(0, 0, 0, 24), (1, 0, 0, 1536), (1, 1, 100, 1536)]


def test_gif_features_are_those_of_rendered_frames(spark):
    docs = frame(spark, ["abc", "x" * 36_864 + "é" * 2000])
    got = {r.doc_id: r.feature for r in gif.features(gif.stored(docs)).collect()}
    for r in gif.frames_of(gif.stored(docs)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("start_ms") + F.col("delay_ms")).alias("end"), F.collect_list("histogram").alias("h")).collect():
        assert got[r.doc_id] == f"{r.n}:{r.end}:" + ",".join(map(str, np.sum(r.h, axis=0).tolist()))
    # The second frame is shorter, and what the first one drew below it is still seen.
    assert sum(map(int, got[1].split(":")[2].split(","))) == 2 * 36_864 * 3


def test_gif_columns_against_plain_ones(spark):
    texts = ["abc", "", None, "é" * 400, "x" * 36_864 + "é" * 2000, "abc"]
    rows = gif.features(gif.stored(frame(spark, texts))).orderBy("doc_id").collect()
    files = {r.doc_id: bytes(r.media) for r in gif.stored(frame(spark, texts)).collect()}
    for r, t in zip(rows, texts, strict=True):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        file = files[r.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256, r.frames, r.delays_ms) == (len(file), hashlib.sha256(file).hexdigest(), -(-len(payload) // 36_864), [100] * r.frames)
        canvas, want = bytearray(payload[:36_864]), Counter()
        for f in range(r.frames):
            part = payload[f * 36_864 : (f + 1) * 36_864]
            canvas[: len(part)] = part
            want += Counter(b >> 5 for b in canvas)
        assert r.red == r.green == r.blue == [want[i] for i in range(8)]


def test_warc(spark):
    big, small = "p" * 1500 + "é", "s" * 20
    html = [big, small, big, small, None, "", "q" * 1000, big]
    pages = spark.createDataFrame([(i, f"http://x/{i}\r\nEvil: 1", h) for i, h in enumerate(html)], "page_id bigint, url string, html string")
    files = warc.write_archives(pages, archive_bytes=3000)
    rows = warc.read_archives(files).orderBy("page_id").collect()
    keep = {big: 7}
    for r, h in zip(rows, html, strict=True):
        raw = (h or "").encode()
        first = keep.get(h, r.page_id)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(raw), hashlib.sha1(raw).hexdigest(), "response" if first == r.page_id else "revisit", None if first == r.page_id else first)
    import zstandard

    file = bytes(files.first().file)
    size = int.from_bytes(file[4:8], "little")
    assert int.from_bytes(file[:4], "little") == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(file[8 : 8 + size])
    assert zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(file[8 + size :]).startswith(b"WARC/1.1\r\n")
    assert {"Evil"}.isdisjoint(k for f in files.collect() for r in warc.records_of(bytes(f.file)) for k in r)


def test_warc_dictionary_knows_late_records():
    rng = np.random.default_rng(6)
    early, late, deep = (rng.integers(0, 256, 400, np.uint8).tobytes() for _ in range(3))
    noise = lambda n: rng.integers(0, 256, n, np.uint8).tobytes()
    records = [early + noise(3600) for _ in range(600)] + [noise(70_000) + deep for _ in range(12)] + [late + noise(3600) for _ in range(600)]
    raw = warc.dictionary_from(records)
    for passage in (early, late, deep):
        assert any(passage[i : i + 64] in raw for i in range(len(passage) - 64))


def test_ordinal_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    ratings = ordinal.rated(labels)
    model = ordinal.train(docs, ratings.where("doc_id % 3 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = ordinal.score(docs, model).join(ratings.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good, bad = held[held.grade == 2], held[held.grade == 0]
    assert good.kept.mean() > 0.93 and bad.kept.mean() < 0.15 and good.expected_grade.mean() > bad.expected_grade.mean() + 1


def test_wavelet_words_are_looked_up_many_at_once(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéßж漢'1.,\n#<|", k=rng.randrange(9))) for _ in range(6_000)] + ["é" * n for n in range(14, 18)] + ["a" * n for n in range(29, 35)] + ["a\0", "a\0\0", "\0", "<|endoftext|>"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(600)] + [None, "", " ", "a ", " a", "a  b", "a   b \n c", "x" * 90 + " b " + "y" * 31, " ".join(words)]
    texts += texts[:200]
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    expected = [np.array(library.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    for bits, bound, size in ((21, 1 << 16, 1 << 19), (12, 500, 3_000), (9, 100, 1)):  # the smaller tables have to forget
        monkeypatch.setattr(wavelet, "TABLE_WORDS", bound)
        monkeypatch.setattr(wavelet, "TEXT_BYTES", size)
        encoder = wavelet.ByteLevelEncoder(tokenizer("byte_bpe_50k.json"))
        encoder.table = wavelet.WordTable(bits)
        column = pa.array(["cut off", *texts, None])[1:-1]
        assert list(encoder.each(column)) == expected
        assert encoder.table.n <= encoder.table.most
        assert list(encoder.each(column[250:300].cast(pa.large_string()))) == expected[250:300] and list(encoder.each(column[:0])) == []
    table = wavelet.WordTable(4)  # words that are asked for stay when room is made
    text = np.frombuffer(bytes(range(97, 123)) + bytes(32), np.uint8)
    keys = table.keys_of(text, np.arange(8), np.full(8, 3))
    table.put(np.arange(40, dtype=np.uint32))
    table.filled = 40
    table.add(keys, np.arange(8) * 5 << 6 | 5)
    held = table.find(keys)
    assert (held >= 0).all() and len(set(held.tolist())) == 8
    table.used[held[2:4]] = True
    table.room(1)
    assert (table.find(keys) >= 0).tolist() == [False, False, True, True, False, False, False, False]
    places = table.at[table.find(keys[2:4])]
    assert table.of(places >> 6, places & 63).tolist() == list(range(10, 20)) and table.n == 2


def test_wavelet_encoder_cuts_signs_and_line_ends_without_the_pattern():
    """The ids are the library's on odd texts, and words with signs behind them or a line end inside take no pattern of their own."""
    encoder = wavelet.ByteLevelEncoder(tokenizer("byte_bpe_50k.json"))
    rng = random.Random(11)
    bits = ["a", "Été", "ß", "漢字", "9", "'s", "'", ".", ",", "$$$", "%", "\n", "\n\n", " ", "  ", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "́", "<|endoftext|>", "<|", "|>", "\x00", "😀"]
    texts = ["", " ", "\n", " \n", "\n ", "a ", "a \n", "a\n b", "a.\nB c.$$$", "x 's\n'll it's", "a <|endoftext|> b<|endoftext|>\nc", *("".join(rng.choices(bits, k=rng.randrange(1, 12))) for _ in range(6000))]
    for text in texts:
        want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(text) == want, repr(text)

    class Counted:
        asked = 0

        def findall(self, text):
            Counted.asked += text not in {"after", "\n", "$$$", "."}
            return wavelet.ByteLevelEncoder.PIECES.findall(text)

    fresh = wavelet.ByteLevelEncoder(tokenizer("byte_bpe_50k.json"))
    fresh.PIECES = Counted()
    fresh.encode("after words$$$ before\nafter")
    assert Counted.asked == 0


def test_wavelet_units_are_cut_where_the_library_cuts_and_asked_for_once():
    """The ids are the library's for every letter of two bytes at most and for odd bytes at cuts, and a stem is put to the model once, whatever signs and line ends follow it."""
    import pyarrow as pa

    encoder = wavelet.ByteLevelEncoder(tokenizer("byte_bpe_50k.json"))
    rng = random.Random(13)
    bits = ["a", "bc", "é", "жx", "ö.", "漢", "9", "'s", "'", ".", ",", "-", "\n", "\n", " ", " ", "  ", "\t", "\r", "\x1c", "\x7f", "\x85", "\xa0", "\xad", "×", "ʹ", "́", " ", "　", "<|endoftext|>", "<|endof", "text|>", "<|", "\0", "😀", "x" * 31]
    texts = [f"{c}a{c}.b {c}, {c}\n{c}c\n{c}d.\n{c}{c} \n{c}" for c in map(chr, range(1 << 11))]
    texts += ["".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(20_000)] + ["<|endof", "text|> a.b", "a\n", "b", "\n", "\nc", " ", " d", "e "]
    want = [np.array(encoder.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    for x, w, got in zip(texts, want, encoder.each(pa.array(texts)), strict=True):
        assert got == w, repr(x)

    class Counted:
        asked = []

        def tokenize(self, unit):
            Counted.asked.append(unit)
            return encoder.model.tokenize(unit)

    fresh = wavelet.ByteLevelEncoder(tokenizer("byte_bpe_50k.json"))
    fresh.model = Counted()
    texts = ["so qwzx qwzx, qwzx. qwzx\nqwzx; qwzx.\nqwzx:", "and qwzé qwzé, qwzé. qwzé\nqwzé; qwzé.\nqwzé:"]
    want = [np.array(encoder.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert list(fresh.each(pa.array(texts))) == want
    assert sum("qwz" in x for x in Counted.asked) == 4  # each stem, with and without a blank before it
