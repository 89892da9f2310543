"""Which files make up each unit to be gated: directories of units, single files, and sets of manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ancestors, dirname, relative
from .units import detect_units

SINGLE_FILE = {"dockerfile": "dockerfile", "github_actions": "workflow", "compose": "compose"}
DIRECTORY = {"helm_chart": "helm_chart", "terraform_module": "terraform_module", "ansible_role": "ansible_role"}
UNIT = ["repo_path", "unit_type", "prefix"]


def directory_units(files: DataFrame, units: DataFrame) -> DataFrame:
    """Files of every unit whose directory contains them; a unit at the root takes root files, templates/ and tasks/ only."""
    path = F.col("file_path")
    wanted = units.where(F.col("unit_kind").isin(*DIRECTORY)).select("repo_path", F.col("unit_kind").alias("unit_type"), "prefix")
    below = files.select("repo_path", "pos", "file_path", F.explode(ancestors(path)).alias("prefix"))
    at_root = ~path.contains("/") | path.startswith("templates/") | path.startswith("tasks/")
    return below.where((F.col("prefix") != "") | at_root).join(wanted, ["repo_path", "prefix"]).select(*UNIT, "pos", "file_path", relative(path, F.col("prefix")).alias("relative"))


def single_files(labels: DataFrame) -> DataFrame:
    """One unit a path; of repeated paths the last file counts."""
    kind = F.create_map(*[F.lit(x) for pair in SINGLE_FILE.items() for x in pair])
    rows = labels.where(F.col("tool").isin(*SINGLE_FILE)).select("repo_path", kind[F.col("tool")].alias("unit_type"), F.col("file_path").alias("prefix"), "pos", "file_path")
    rows = rows.groupBy(*UNIT).agg(F.max("pos").alias("pos"), F.first("file_path").alias("file_path"))
    return rows.select(*UNIT, "pos", "file_path", F.element_at(F.split("file_path", "/"), -1).alias("relative"))


def manifest_sets(labels: DataFrame) -> DataFrame:
    """Directories with two or more files labelled kubernetes, repeated rows counted."""
    rows = labels.where("tool = 'kubernetes'").select("repo_path", F.lit("manifest_set").alias("unit_type"), dirname(F.col("file_path")).alias("prefix"), "pos", "file_path")
    enough = rows.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select(*UNIT)
    return rows.join(enough, UNIT, "left_semi").select(*UNIT, "pos", "file_path", F.element_at(F.split("file_path", "/"), -1).alias("relative"))


def candidates(files: DataFrame, labels: DataFrame, units: DataFrame | None = None) -> DataFrame:
    units = detect_units(files) if units is None else units
    return directory_units(files, units).unionAll(single_files(labels)).unionAll(manifest_sets(labels))
