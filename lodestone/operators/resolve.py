"""The final label of every file: its unit, its content and its path, in that order of trust."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.detectors import KIND_TO_TOOL, yaml_kind
from ..functions.dialect import Pattern
from ..functions.path_rules import YAML, YAML_OR_TEMPLATE, classify
from ..functions.scalars import ancestors, relative
from .units import detect_units

# What belongs to a chart or a role below its directory, and paths that stand for themselves.
CHART_MEMBER = Pattern(rf"\A(Chart{YAML}|Chart\.lock|values[^/]*{YAML}|values\.schema\.json|\.helmignore|(templates|charts|crds)/[^\n]*)\z", "i")
ROLE_MEMBER = Pattern(r"\A(tasks|handlers|defaults|vars|meta|templates|files|library|molecule)/", "i")
CANONICAL = ["azure_pipelines", "buildkite", "circleci", "codebuild", "compose", "drone", "github_actions", "gitlab_ci", "helm", "helmfile", "kustomize", "pulumi", "serverless", "skaffold", "tekton", "travis"]


def contexts(files: DataFrame, units: DataFrame) -> DataFrame:
    """(repo_path, pos, chart, role): the deepest chart and role that each file is a member of. Every file meets its own ancestors only."""
    prefixes = units.where(F.col("unit_kind").isin("helm_chart", "helm_umbrella", "ansible_role")).select("repo_path", "prefix", F.when(F.col("unit_kind") == "ansible_role", "role").otherwise("chart").alias("kind"))
    below = files.select("repo_path", "pos", "file_path", F.explode(ancestors(F.col("file_path"))).alias("prefix"))
    met = below.join(prefixes, ["repo_path", "prefix"]).withColumn("rest", relative(F.col("file_path"), F.col("prefix")))
    member = F.when(F.col("kind") == "chart", CHART_MEMBER.found(F.col("rest"))).otherwise(ROLE_MEMBER.found(F.col("rest")))
    deepest = lambda kind: F.max_by(F.when(F.col("kind") == kind, F.col("prefix")), F.when(F.col("kind") == kind, F.length("prefix")))
    return met.where(member).groupBy("repo_path", "pos").agg(deepest("chart").alias("chart"), deepest("role").alias("role"))


def labelled(files: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """(repo_path, pos, file_path, tool, precision, evidence, unit) of every file; tool is null for unlabelled ones. Contents are read for their kind and not shuffled."""
    path = F.col("file_path")
    has_content = F.col("content").isNotNull() & YAML_OR_TEMPLATE.found(path) if "content" in files.columns else F.lit(False)
    kind = F.when(has_content, yaml_kind(F.col("content"), path)) if "content" in files.columns else F.lit(None).cast("string")
    narrow = files.select("repo_path", "pos", "file_path", classify(path, F.col("language")).alias("prior"), kind.alias("kind"))
    found = contexts(files, detect_units(files) if units is None else units)
    rows = narrow.join(found, ["repo_path", "pos"], "left")
    by_kind = F.create_map(*[F.lit(x) for pair in KIND_TO_TOOL.items() for x in pair])
    content_tool = F.try_element_at(by_kind, F.col("kind"))
    prior, sure = F.col("prior.tool"), F.coalesce(F.col("prior.tool").isin(CANONICAL), F.lit(False))

    def label(tool, precision, evidence, unit=None):
        return F.struct(tool.alias("tool"), precision.alias("precision"), evidence.alias("evidence"), (F.lit(None).cast("string") if unit is None else unit).alias("unit"))

    path_word = F.lit("path")
    result = (
        F.when(F.col("chart").isNotNull(), label(F.lit("helm"), F.lit("structural"), F.lit("context"), F.col("chart")))
        .when(F.col("role").isNotNull(), label(F.lit("ansible"), F.lit("structural"), F.lit("context"), F.col("role")))
        .when(content_tool.isNotNull(), label(content_tool, F.lit("exact"), F.when(prior == content_tool, "path+content").otherwise("content")))
        .when(F.col("kind").isNotNull(), F.when(sure, label(prior, F.lit("structural"), path_word)))
        .when(prior.isNull(), None)
        .when((F.col("prior.precision") == "exact") | sure | ~YAML_OR_TEMPLATE.found(path), label(prior, F.col("prior.precision"), path_word))
        .otherwise(label(prior, F.lit("heuristic"), path_word))
    )
    return rows.withColumn("r", result).select("repo_path", "pos", "file_path", "r.tool", "r.precision", "r.evidence", "r.unit")
