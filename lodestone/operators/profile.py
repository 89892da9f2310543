"""Profiles of unit classes: sums, numeric summaries by index, and a stable sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import star_bucket
from ..sources.publish import QUALITY

SEED = 17


def _fields(kind: str) -> dict[str, list[str]]:
    """The quality fields of one type, by class, from the published schema."""
    rows = {t: [f.split(": ") for f in ddl.split(", ")] for t, ddl in QUALITY.items()}
    return {t: [name for name, type_ in fields if type_ == kind] for t, fields in rows.items()}


NUMERIC, BOOLEAN = _fields("int"), _fields("boolean")


def class_profile(units: DataFrame) -> DataFrame:
    """Units, files and characters of each class, means, and the percent of units with a permissive licence."""
    size = F.aggregate("files", F.lit(0).cast("bigint"), lambda a, f: a + F.coalesce(f["size_bytes"], F.lit(0)))
    rows = units.select("unit_type", F.size("files").alias("n"), size.alias("b"), F.array_contains(F.coalesce("license_types", F.array().cast("array<string>")), "permissive").alias("free"))
    out = rows.groupBy("unit_type").agg(F.count(F.lit(1)).alias("units"), F.sum("n").cast("bigint").alias("files"), F.sum("b").alias("bytes"), F.count_if("free").alias("free"))
    return out.select("unit_type", "units", "files", F.round(F.col("files") / F.col("units"), 2).alias("mean_files_per_unit"), F.round(F.col("bytes") / F.col("units"), 2).alias("mean_bytes_per_unit"), F.round(100 * F.col("free") / F.col("units"), 2).alias("permissive_pct"))


def licence_tally(units: DataFrame) -> DataFrame:
    """Units by licence type: one with several counts for each, one with none as none."""
    types = F.coalesce("license_types", F.array().cast("array<string>"))
    return units.select("unit_type", F.explode(F.when(F.size(types) == 0, F.array(F.lit("none"))).otherwise(types)).alias("license")).groupBy("unit_type", "license").agg(F.count(F.lit(1)).alias("units"))


def star_tally(units: DataFrame) -> DataFrame:
    return units.groupBy("unit_type", star_bucket(F.col("stars")).alias("bucket")).agg(F.count(F.lit(1)).alias("units"))


def boolean_tally(units: DataFrame, unit_type: str) -> DataFrame:
    fields = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"quality.{n}").alias("value")) for n in BOOLEAN[unit_type]])
    rows = units.where(F.col("unit_type") == unit_type).select(F.explode(fields).alias("x"))
    return rows.groupBy("x.field").agg(F.count_if("x.value").alias("yes"), F.count(F.lit(1)).alias("units"))


def kind_tally(units: DataFrame) -> DataFrame:
    return units.select(F.explode("quality.kinds").alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("units"))


def numeric_profile(rows: DataFrame, group: str, value: str) -> DataFrame:
    """min, p50, p90, max and mean of a whole-number column. Quantiles are the entries at places n div 2 and 0.9 n of the sorted
    values. Equal values are counted first, so what is ordered grows with distinct values, not rows."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(group)
    placed = counts.withColumn("upto", F.sum("c").over(w.orderBy(value))).withColumn("n", F.sum("c").over(w))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col(value)))
    return placed.groupBy(group).agg(
        F.min(value).alias("min"), at(F.floor(F.col("n") / 2)).alias("p50"), at(F.floor(F.col("n") * 0.9)).alias("p90"), F.max(value).alias("max"),
        F.round(F.sum(F.col(value) * F.col("c")) / F.sum("c"), 2).alias("mean"),
    )


def stable_sample(units: DataFrame, per_class: int, seed: int = SEED, key: tuple[str, ...] = ("repo_path", "unit_prefix")) -> DataFrame:
    """At most so many units of each class, the least by a seeded hash: the same rows for the same seed, whatever the order."""
    draw = F.xxhash64(F.lit(seed), *[F.col(k) for k in key])
    order = Window.partitionBy("unit_type").orderBy("_draw", *key)
    return units.withColumn("_draw", draw).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_class).drop("_draw", "_n")


def materialised_paths(units: DataFrame) -> DataFrame:
    """(unit_type, repo_path, unit_prefix, target, content): where each file of a unit would be put, with safe names."""
    from .finalize import unit_relative

    rows = units.select("unit_type", "repo_path", "unit_prefix", F.explode("files").alias("f"))
    name = F.concat_ws("__", F.regexp_replace("repo_path", r"[^A-Za-z0-9._-]", "_"), F.nullif(F.regexp_replace(F.coalesce("unit_prefix", F.lit("")), r"[^A-Za-z0-9._-]", "_"), F.lit("")))
    rest: Column = unit_relative(F.col("f.path"), F.coalesce("unit_prefix", F.lit("")), F.col("unit_type"))
    return rows.select("unit_type", "repo_path", "unit_prefix", F.concat_ws("/", "unit_type", name, F.regexp_replace(rest, r"[^A-Za-z0-9._/-]", "_")).alias("target"), F.col("f.content").alias("content"))


def write_folders(sample: DataFrame, root: str) -> int:
    """Puts each unit of a bounded sample into a folder of its own under root, with its provenance; returns how many files. Rows come to the driver one at a time."""
    import json
    from pathlib import Path

    units, files = set(), 0
    for row in materialised_paths(sample).toLocalIterator():
        target = Path(root, *[part for part in row.target.split("/") if part not in ("", ".", "..")])
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(row.content or "", encoding="utf-8")
        folder = Path(root, *row.target.split("/")[:2])
        if folder not in units:
            units.add(folder)
            (folder / "_provenance.json").write_text(json.dumps({"unit_type": row.unit_type, "repo_path": row.repo_path, "unit_prefix": row.unit_prefix}), encoding="utf-8")
        files += 1
    return files
