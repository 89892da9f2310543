"""Quality rules: word statistics, and a hashed n-gram log-likelihood ratio against the raw corpus.

Words and pairs of words are hashed into buckets. Two multinomials over the buckets are counted,
one over trusted target documents and one over every document; a text's score is the mean, over
its n-grams, of the log of the ratio of the two. The raw count leaves out the occurrence that is being
scored, and both sides get PRIOR pseudo-counts in proportion, so an n-gram seen nowhere else says
nothing and one rarely seen says little. Every document is held against one fixed threshold. The trusted target is a sample of labelled rows whose size is bounded by a
parameter, so its ids are broadcast; the raw counts cover the whole table. All of it is DataFrame
expressions: two scans of the texts and one shuffle, of bucket counts.

A null or blank text has no words and fails the base rules, as n_words is below their minimum.
Repeated rows score alike. An empty table gives an empty result. Without any trusted document the
ratio is 0 everywhere, and only the base rules decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import WORD_GAPS, without, words_of, written

BUCKET_BITS = 18
#: Labelled rows that the target is taken from, at most (the least by hash of doc_id); 8 bytes each when broadcast.
TRUSTED_ROWS = 20_000
#: Score under which a document is rejected.
THRESHOLD = -0.12
PRIOR = 2.0
WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED_PERCENT = 30
VERDICT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"]
SYMBOLS = "#*$%&|<>"


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def joined(hashes: Column, apart: int) -> Column:
    """Hashes of runs twice as long: each hash with the one `apart` places on."""
    n = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(apart + 1), n), lambda a, b: F.xxhash64(a, b))


def bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int")


def ratio_table(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", most: int = TRUSTED_ROWS) -> DataFrame:
    """One row, `ratios array<float>`: each bucket's log-ratio. `trusted` has the ids of target documents."""
    ids = trusted.select(F.col(key).cast("long").alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select(F.col(key).cast("long").alias("_key"), words_of(F.col(text)).alias("_words"))
    rows = rows.join(F.broadcast(ids), F.col("_key") == F.col("_id"), "left")
    rows = rows.select(F.when(F.col("_id").isNotNull(), 1).otherwise(0).alias("t"), word_hashes(F.col("_words")).alias("_one"))
    grams = rows.select("t", F.explode(F.concat("_one", joined(F.col("_one"), 1))).alias("h")).select("t", bucket(F.col("h")).alias("b"))
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    n = 1 << BUCKET_BITS
    every = docs.sparkSession.range(0, n, 1, 1).select(F.col("id").cast("int").alias("b"))
    counts = every.join(counts, "b", "left").select("b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    # A fixed number of buckets: this aggregate gathers as much at any size of the corpus.
    gathered = counts.agg(F.sum("raw").alias("r"), F.sum("target").alias("t"), F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("c"))
    expected = lambda x: F.greatest(x["raw"] - 1, F.lit(0)) * F.col("t") / F.col("r")
    ratio = F.transform("c", lambda x: F.when(F.col("t") > 0, F.log((x["target"] + PRIOR) / (expected(x) + PRIOR))).otherwise(0.0).cast("float"))
    return written(gathered.select(ratio.alias("ratios")), "ratios")


def again(hashes: Column) -> Column:
    """How many entries equal an earlier one."""
    return F.size(hashes) - F.size(F.array_distinct(hashes))


def covered(hashes: Column) -> Column:
    """Words covered by windows whose hash is there again, from the array of all window hashes."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = lambda s: F.flatten(F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    at = F.sort_array(F.array_distinct(twice(ordered)))
    walk = F.aggregate(
        at,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
    )
    return F.when(again(hashes) > 0, walk["n"]).otherwise(0)


def judged(docs: DataFrame, ratios: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed and kept; columns of docs with these names give way."""
    rows = _verdicts(docs, ratios, text, threshold)
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in VERDICT], *VERDICT)


def _verdicts(docs: DataFrame, ratios: DataFrame, text: str, threshold: float) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(" " + WORD_GAPS)) != "")
    own = ["_row"]
    # One projection a step, and each array left behind as soon as it has been used: a projection copies all arrays it hands on.
    rows = docs.select(F.struct("*").alias("_row"), whole.alias("_text"), words_of(F.col(text).cast("string")).alias("_words"), lines.alias("_lines"))
    n, whole = F.size("_words"), F.col("_text")
    rows = rows.select(
        *own,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.octet_length(whole) - F.octet_length(without(whole, SYMBOLS))).cast("long").alias("n_symbols"),
        again(F.col("_lines")).cast("long").alias("n_dup_lines"),
        word_hashes(F.col("_words")).alias("_one"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    rows = rows.select(*own, *counts, "_one", joined(F.col("_one"), 1).alias("_two"))
    # The table is used once and right above where it is added, so the two projections become one and no row carries a copy of it.
    rows = rows.withColumn("_ratios", ratios.select("ratios").scalar())
    score = F.aggregate(F.concat("_one", "_two"), F.lit(0.0), lambda a, h: a + F.get(F.col("_ratios"), bucket(h)))
    # Windows of 8 words are hashed from pairs of runs of 4, those from pairs of 2. A window that is there twice repeats 7 of its
    # runs of 2 and 5 of its runs of 4, so a text with fewer repeats needs no longer runs.
    none = F.array().cast("array<bigint>")
    four = F.when(again(F.col("_two")) >= WINDOW - 1, joined(F.col("_two"), 2)).otherwise(none)
    rows = rows.select(*own, *counts, F.when(F.col("n_words") > 0, score / (2 * F.col("n_words") - 1)).otherwise(0.0).alias("score"), four.alias("_four"))
    rows = rows.select(*own, *counts, "score", F.when(again(F.col("_four")) >= WINDOW - 3, joined(F.col("_four"), 4)).otherwise(none).alias("_eight"))
    rows = rows.select(*own, *counts, covered(F.col("_eight")).cast("long").alias("n_repeat_words"), "score")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def accepted(docs: DataFrame, ratios: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are kept. A filter on a verdict would be pushed below the projections that work it out, each of its
    inputs evaluated again and again; a projection with a task number in it lets no filter through."""
    rows = _verdicts(docs, ratios, text, threshold).withColumn("_task", F.spark_partition_id())
    return rows.where(F.col("kept") & (F.col("_task") >= 0)).select("_row.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The target: documents labelled good and not toxic."""
    return labels.where("quality = 1 and toxic = 0").select("doc_id")
