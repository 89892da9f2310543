"""From documents to token ids: quality rules, near duplicates, repeated passages, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, factors, jaccard, mixing, rules
from lodestone.llm._common import table, written
from lodestone.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the log-likelihood ratio reject go."""
    ratios = rules.ratio_table(docs, rules.trusted_ids(table(spark, sf_dir, "labels")))
    return rules.accepted(docs, ratios)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row stays, that of the least doc_id (null comes last); texts without words link with nothing and stay.

    Texts are compared, not doc_ids: of a doc_id on two texts each one stays or goes by itself, and of a row that is there twice one stays."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.xxhash64(text)  # a text's own name; texts under one doc_id are told apart by it
    membership, _ = jaccard.similar(docs.select(name.alias("name"), text.alias("text")), key="name")
    groups = membership.where("n_shingles > 0").select("name", "component_id").distinct()
    rows = docs.select(F.col("doc_id").alias("id"), name.alias("name")).join(groups, "name")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "name")
    first = rows.groupBy("component_id").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = rows.groupBy("id", "name", "component_id").agg(F.count(F.lit(1)).alias("times")).join(first, "component_id")
    stays = (F.col("id").eqNullSafe(F.col("first.id"))) & (F.col("name") == F.col("first.name"))
    told = written(counts.select("id", "name", stays.alias("stays"), "times").where("not stays or times > 1"), "copies")
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), name.alias("name"))
    there = lambda t: own["id"].eqNullSafe(t["id"]) & (own["name"] == t["name"])
    twice = told.where("stays and times > 1")
    once = own.join(twice, there(twice), "left_semi").dropDuplicates(["id", "name"])
    return own.join(told, there(told), "left_anti").unionAll(once).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages are cut out, the first stays; a text of which nothing is left goes, an empty or null one included.

    A passage has factors.PASSAGE bytes or more, some 50 words, where op3's contract asks for 400: half of the repeated passages of 51
    words or more are shorter than that."""
    cut = factors.deduplicated(docs, min_length=factors.PASSAGE, keep="first", whole_rows=True).where("text <> ''")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to weights of the square root of their rows, at as many rows as come in."""
    return mixing.mixed(docs, weight=F.sqrt)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded texts, as digests."""
    return bpe.encode_decode(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("encode", encode),
]

#: The log-likelihood ratio, the join's trees and the BPE encoder are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
