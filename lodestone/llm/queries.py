"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, factors, gif, jaccard, mixing, oracles, ordinal, rules, sharding, warc, wavelet
from ._common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.score(docs, ordinal.train(docs, ordinal.rated(table(spark, sf_dir, "labels"))))


def op2_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))[0].select("doc_id", "n_shingles", "component_id")


def op3_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.deduplicated(table(spark, sf_dir, "documents"), passages=factors.PASSAGE)


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), sharding.tree_of(16))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    numbers = [F.col(c).cast("long").alias(c) for c in ("n_copies", "copy")]
    return mixing.replicate(docs, weight=F.sqrt).select(*docs.columns, *numbers, "shuffle_key")


def op6_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = rules.ratio_table(docs, rules.trusted_ids(table(spark, sf_dir, "labels")))
    return rules.judged(docs, ratios).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("score", 6).alias("score"))


def op7_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wavelet.write_files(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return wavelet.read_files(files)


def op8_gif_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.features(gif.stored(table(spark, sf_dir, "documents")))


def op9_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))


def op10_backtrack_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (op1_ordinal_quality, op2_signature_trees, op3_previous_factors, op4_hash_tree_shards, op5_poisson_mix, op6_ratio_rules, op7_wavelet_files, op8_gif_frames, op9_dictionary_warc, op10_backtrack_bpe)}
ORACLES: dict[str, str] = {"op2_signature_trees": oracles.OP2, "op4_hash_tree_shards": oracles.OP4, "op5_poisson_mix": oracles.OP5, "op9_dictionary_warc": oracles.OP9}
