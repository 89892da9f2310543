"""Helpers shared by the operators: tables in the shared folder, word rules, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, in the contracts: space and the controls 9 to 13.
WORD_GAPS = "\t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a folder of our own only where it is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        kept = spark.conf.get("lodestone.shared.dir", "")
        found = kept or tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("lodestone.shared.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends here, and a lost executor costs no upstream work."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lodestone/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(text: Column, characters: str, instead: str = "") -> Column:
    """Replaces each of a few ASCII characters. Spark's replace searches bytes; its translate looks up every character."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(instead))
    return text


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text; none for null. A single-character split keeps Java off its regex path."""
    return F.array_remove(F.split(without(F.coalesce(text, F.lit("")), WORD_GAPS, " "), " "), "")


class Memo(dict):
    """A dict that fills itself. It holds two generations at most: when the younger one has reached the bound, the older one is
    forgotten, and keys beyond LONGEST are worked out anew each time, so a worker's memory stays bounded and what is often asked for stays."""

    LONGEST = 256

    def __init__(self, make: Callable, most: int = 400_000):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.LONGEST:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


#: Rows of a batch that are worked on, and go back to Spark, together.
PART_ROWS = 1_024


def parts(batches, rows: int = PART_ROWS):
    """Batches in parts of so many rows at most: lists made of a part, and what Spark holds of the answer, are bounded by it."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches, key: int = 0):
    """From batches sorted by a column: (value, table) for each run of equal values, across batch borders. Holds one run at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        column = t.column(key).combine_chunks()
        change = pc.fill_null(pc.not_equal(column[1:], column[:-1]), False) if len(column) > 1 else pa.array([], pa.bool_())
        cuts = [0, *(i + 1 for i in pc.indices_nonzero(change).to_pylist()), t.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column(key)[0] != column[a]:
                yield held[0].column(key)[0].as_py(), pa.concat_tables(held)
                held = []
            held.append(t.slice(a, b - a))
    if held:
        yield held[0].column(key)[0].as_py(), pa.concat_tables(held)


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge table, component the least node reachable: large-star and small-star rounds until nothing moves.

    Each round is a few joins and aggregates on the edges; its result is written to the shared folder. Edges never reach the driver.
    """
    x, y = F.col(a), F.col(b)
    pairs = written(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = written(small, "edges")
        # Done when every node points at a root and roots point nowhere: one edge a node, and no node is both child and parent.
        settled = new.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() == 0 and new.join(new.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count() == 0
        pairs = new
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
