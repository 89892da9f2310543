"""Poisson replication: sources are mixed to target weights by repeating each document at random.

Each source has a rate, its target rows over its rows. A document's number of copies is the
Poisson distribution of that mean inverted at a uniform hashed from seed and doc_id, so a run
repeats exactly and a document's count depends on itself and its source's rate alone. Copies
are exploded, keyed by another hash and sorted by it over the whole cluster.

Rates above STEP are drawn as a sum of Poisson counts of smaller means, which has the same law,
so no rate is capped. A null source is a source of its own; a null doc_id draws as one key;
repeated rows draw the same count each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRAW_BITS = 52
#: Largest mean that is inverted at once.
STEP = 64.0
#: Sources up to which their rates are broadcast (some 20 bytes and a short list each); more are joined with salt.
BROADCAST_SOURCES = 2_000
SALT = 64


def hashed(seed: str, *keys: Column) -> Column:
    """An integer of DRAW_BITS bits."""
    text = F.concat_ws("/", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")


def rates(docs: DataFrame, source: str, weight: Callable[[Column], Column] | dict, epochs: float) -> DataFrame:
    """One row for each source: its rows, rate, steps and the cumulative Poisson law of a step. Weights: a rule on a source's rows, or a dict by source."""
    counts = docs.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    if callable(weight):
        counts = counts.withColumn("w", weight(F.col("n")))
    else:
        table = F.create_map(*[F.lit(x) for pair in weight.items() for x in pair])
        counts = counts.withColumn("w", F.coalesce(F.element_at(table, F.coalesce(F.col(source), F.lit(""))), F.lit(0.0)))
    totals = counts.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w")).select(F.struct("all_n", "all_w").alias("t")).scalar()
    rated = counts.withColumn("rate", F.lit(float(epochs)) * totals["all_n"] * F.col("w") / totals["all_w"] / F.col("n"))
    rated = rated.withColumn("steps", F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)).cast("int")).withColumn("mean", F.col("rate") / F.col("steps"))
    most = (F.col("mean") + 12 * F.sqrt("mean") + 24).cast("int")
    law = F.aggregate(
        F.sequence(F.lit(1), most),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.exp(-F.col("mean")).alias("c"), F.array(F.exp(-F.col("mean"))).alias("law")),
        lambda a, k: F.struct((a["p"] * F.col("mean") / k).alias("p"), (a["c"] + a["p"] * F.col("mean") / k).alias("c"), F.concat(a["law"], F.array(a["c"] + a["p"] * F.col("mean") / k)).alias("law")),
    )
    return rated.select(F.col(source), "n", "rate", "steps", law["law"].alias("law"))


def _copies(docs: DataFrame, weight: Callable[[Column], Column] | dict, epochs: float, key: str, source: str, seed: str) -> DataFrame:
    """(_row, _key, _n, _copy, _order) for every copy, in the global order. The sources' table is broadcast only below a checked size."""
    right = rates(docs, source, weight, epochs).select(F.col(source).alias("_source"), F.col("steps").alias("_steps"), F.col("law").alias("_law"))
    left = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), F.col(source).alias("_own"))
    many = docs.select(source).distinct().limit(BROADCAST_SOURCES + 1).count()
    same = F.col("_own").eqNullSafe(F.col("_source"))
    if many <= BROADCAST_SOURCES:
        joined = left.join(F.broadcast(right), same)
    else:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(F.coalesce(F.col("_key").cast("string"), F.lit(""))), F.lit(SALT)))
        right = right.withColumn("_of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
        joined = left.join(right, same & (F.col("_salt") == F.col("_of")))
    uniform = lambda i: (hashed(seed, F.col("_key"), i) + F.lit(0.5)) / float(1 << DRAW_BITS)
    count = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col("_steps")), lambda i: F.struct(uniform(i).alias("u"))),
        F.lit(0),
        lambda a, x: a + F.size(F.filter(F.col("_law"), lambda c: c <= x["u"])),
    )
    counted = joined.select("_row", "_key", count.alias("_n"))
    copies = counted.select("*", F.explode(F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1))).alias("_copy"))
    return copies.withColumn("_order", hashed(f"{seed}/order", F.col("_key"), F.col("_copy"))).orderBy("_order", "_key", "_copy")


def replicate(docs: DataFrame, weight: Callable[[Column], Column] | dict, epochs: float = 1.0, key: str = "doc_id", source: str = "source", seed: str = "mix") -> DataFrame:
    """docs' columns with n_copies, copy (from 0) and shuffle_key, sorted by it; columns of docs with these names give way."""
    new = {"n_copies": F.col("_n"), "copy": F.col("_copy"), "shuffle_key": F.col("_order")}
    own = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in new]
    return _copies(docs, weight, epochs, key, source, seed).select(*own, *[c.alias(n) for n, c in new.items()])


def mixed(docs: DataFrame, weight: Callable[[Column], Column] | dict, epochs: float = 1.0, key: str = "doc_id", source: str = "source", seed: str = "mix") -> DataFrame:
    """docs' own columns, each row as often as it is drawn, in the global order."""
    return _copies(docs, weight, epochs, key, source, seed).select("_row.*")
