"""Hierarchical weighted hash tree: every row descends region, rack and shard by weighted draws.

At each level a node's children draw `-ln(u) / weight`, u hashed from the row's key and the
child's name, and the least draw wins. A child's draw depends on its own name and weight only,
so raising a weight moves rows into that subtree, lowering it moves rows out of it, and nothing
moves between siblings whose weights stay. A shard that is added later opens a region of its own
(`grown`): as no other subtree changes weight, it takes rows only into itself.

Everything is DataFrame expressions. Slots number each shard's rows from 0 without a window over
a whole shard: key ranges, bounded by quantiles so that outliers don't widen them, are numbered
apart and shifted by the counts of those before. Rows of one key stay in one range.
An empty table gives an empty result; extra columns are ignored, whatever their names. A null key is a key like any other and takes the first slots; a null text has no bytes (size 1,
checksum 0); rows with equal keys go to one shard and get slots by checksum and size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key range, over all shards, and ranges at most: beyond that, ranges grow, a shard's share of one staying n / 65,536 rows for 16 shards.
RANGE_ROWS, MOST_RANGES = 50_000, 4_096
#: Of the quantiles that bound the ranges; a quantile may be off by n / ACCURACY rows.
ACCURACY = 40_000
DRAW_BITS = 48


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree_of(shards: int, regions: int = 2, racks: int = 2, founding: int = 16) -> list[Shard]:
    """The standing layout: founding shards fill regions and racks evenly; each later one has a region of its own."""
    per_rack = max(1, founding // (regions * racks))
    first = [Shard(f"r{i // (racks * per_rack)}", f"k{i // per_rack % racks}", i) for i in range(min(shards, founding))]
    return first + [Shard(f"n{i}", "k0", i) for i in range(founding, shards)]


def grown(tree: list[Shard]) -> list[Shard]:
    """One more shard, in a region that no row drew before."""
    new = max(s.shard for s in tree) + 1
    return [*tree, Shard(f"n{new}", "k0", new)]


def draw(key: Column, name: str, weight: float, seed: str) -> Column:
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}/{name}/"), key)), 1, DRAW_BITS // 4)
    uniform = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << DRAW_BITS)
    return -F.log(uniform) / weight


def placed(rows: DataFrame, tree: list[Shard], key: str, into: str, seed: str = "tree") -> DataFrame:
    """Adds the shard of each row as column `into`. Level by level, and only the branch that a row has descended is evaluated for it."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    weights: dict[str, dict[str, float]] = {}
    for s in tree:
        path = ""
        for step in (s.region, s.rack, str(s.shard)):
            below = weights.setdefault(path, {})
            below[step] = below.get(step, 0.0) + s.weight
            path = f"{path}/{step}"

    def choose(path: str) -> Column:
        below = weights[path]
        if len(below) == 1:
            return F.lit(f"{path}/{next(iter(below))}")
        draws = [F.struct(draw(name, f"{path}/{step}", w, seed).alias("draw"), F.lit(f"{path}/{step}").alias("path")) for step, w in below.items()]
        return F.array_min(F.array(*draws))["path"]

    rows = rows.withColumn(into, choose(""))
    for level in (1, 2):
        case = None
        for path in (p for p in weights if p.count("/") == level):
            case = (F if case is None else case).when(F.col(into) == path, choose(path))
        rows = rows.withColumn(into, case)
    return rows.withColumn(into, F.substring_index(into, "/", -1).cast("int"))


def below(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are below a value, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    # Places behind the last bound give null, which is not below anything.
    held, at = F.array(*map(F.lit, bounds)), lambda i: F.get(held, i)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda found, step: F.when(at(found + step - 1) < value, found + step).otherwise(found))


def with_slots(rows: DataFrame, key: str, shard: str, ties: list[str]) -> DataFrame:
    """Adds slot: the row's number within its shard in key order, gapless from 0. Two aggregates and one window over key ranges."""
    fractions = [i / MOST_RANGES for i in range(1, MOST_RANGES)]
    n, quantiles = rows.agg(F.count(F.lit(1)), F.percentile_approx(key, fractions, ACCURACY)).first()
    bounds = sorted(set((quantiles or [])[:: max(1, MOST_RANGES * RANGE_ROWS // max(n, 1))] if n > RANGE_ROWS else []))
    rows = rows.withColumn("_range", F.when(F.col(key).isNull(), -1).otherwise(below(F.col(key), bounds)))
    counts = rows.groupBy(shard, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(shard, "_range", F.coalesce(before, F.lit(0)).alias("_start"))
    order = Window.partitionBy(shard, "_range").orderBy(F.col(key).asc_nulls_first(), *ties)
    return rows.withColumn("_at", F.row_number().over(order)).join(starts, [shard, "_range"]).withColumn("slot", (F.col("_start") + F.col("_at") - 1).cast("long")).drop("_range", "_start", "_at")


def shard_documents(docs: DataFrame, tree: list[Shard], key: str = "doc_id", text: str = "text", seed: str = "tree") -> DataFrame:
    rows = docs.select(
        F.col(key).cast("long").alias(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    rows = placed(placed(rows.withColumn("law", F.lit("key")), tree, key, "shard", seed), grown(tree), key, "grown_shard", seed)
    return with_slots(rows, key, "shard", ["text_crc32", "size"]).select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
