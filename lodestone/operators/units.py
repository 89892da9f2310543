"""Directories that hold a complete unit: charts, modules, roles, overlays, compose projects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import Pattern
from ..functions.path_rules import NOISE, UNIT_PREFILTER, YAML
from ..functions.scalars import basename, dirname

# Base names that mark a directory, in order.
MARKS = [
    ("chart", Pattern(rf"\AChart{YAML}\z", "i")),
    ("values", Pattern(rf"\Avalues[^/]*{YAML}\z", "i")),
    ("kustomize", Pattern(rf"\Akustomization{YAML}\z", "i")),
    ("compose", Pattern(rf"\A(docker-)?compose[^/]*{YAML}\z", "i")),
    ("terraform", Pattern(r"\.tf\z")),
]
ROLE = r"(?i)^((?:.*?/)?roles/[^/]+)/(?:tasks|handlers|defaults)/[^/]+\.ya?ml\z"
UNIT_KINDS = ["helm_chart", "helm_umbrella", "helm_chart_with_values", "terraform_module", "terraform_dir", "ansible_role", "kustomize_dir", "compose_project"]


def marks(files: DataFrame) -> DataFrame:
    """(repo_path, prefix, mark): what each path says of a directory. Only path columns are touched."""
    path = F.col("file_path")
    base, folder = basename(path), dirname(path)
    kind = None
    for name, pattern in MARKS:
        kind = (F if kind is None else kind).when(pattern.found(base), name)
    template = F.concat(F.lit("/"), path).contains("/templates/")
    head = F.regexp_replace(path, r"(?s)(^|/)templates/.*\z", "")
    role = F.regexp_extract(path, ROLE, 1)
    found = F.array(
        F.when(kind.isNotNull(), F.struct(folder.alias("prefix"), kind.alias("mark"))),
        F.when(template, F.struct(head.alias("prefix"), F.lit("template").alias("mark"))),
        F.when(role != "", F.struct(role.alias("prefix"), F.lit("role").alias("mark"))),
    )
    kept = files.where(UNIT_PREFILTER.found(path) & ~NOISE.found(path))
    return kept.select("repo_path", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("m")).select("repo_path", "m.prefix", "m.mark")


def detect_units(files: DataFrame) -> DataFrame:
    """(repo_path, unit_kind, prefix): one shuffle by directory, counted before it."""
    has = lambda mark: F.max(F.when(F.col("mark") == mark, 1).otherwise(0)) == 1
    folders = marks(files).groupBy("repo_path", "prefix").agg(
        *[has(m).alias(m) for m in ("chart", "values", "template", "role", "kustomize", "compose")],
        F.count_if(F.col("mark") == "terraform").alias("tf"),
    )
    kinds = {
        "helm_chart": F.col("chart") & F.col("template"),
        "helm_umbrella": F.col("chart") & ~F.col("template"),
        "helm_chart_with_values": F.col("chart") & F.col("template") & F.col("values"),
        "terraform_module": F.col("tf") >= 2,
        "terraform_dir": F.col("tf") >= 1,
        "ansible_role": F.col("role"),
        "kustomize_dir": F.col("kustomize"),
        "compose_project": F.col("compose"),
    }
    named = F.array_compact(F.array(*[F.when(c, k) for k, c in kinds.items()]))
    return folders.select("repo_path", F.explode(named).alias("unit_kind"), "prefix")


def unit_counts(files: DataFrame) -> DataFrame:
    return detect_units(files).groupBy("unit_kind").agg(F.count(F.lit(1)).alias("units"), F.count_distinct("repo_path").alias("repos"))
