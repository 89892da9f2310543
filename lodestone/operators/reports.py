"""Sizing, validation, measurement and licence reports: grouped aggregates over the file table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.detectors import GO_ACTION, is_dockerfile, is_terraform, looks_generated, yaml_kind
from ..functions.path_rules import ADJACENT_TOOLS, LICENSE_FILE, SCAN_PREFILTER, YAML_FILE, classify
from ..functions.scalars import basename, or_else, scaled, share, star_bucket
from ..functions.yaml_facts import yaml_facts

MOST_LANGUAGES, MOST_KEYS, MOST_SIGNATURES, MOST_NAMES = 30, 25, 25, 15
ARBITERS = [("kubernetes", "is_k8s"), ("github_actions", "is_gha"), ("ansible", "is_ansible"), ("compose", "is_compose")]


def scanned(files: DataFrame) -> DataFrame:
    """Files that the scan's cheap gate and then a rule match, with tool and precision."""
    path = F.col("file_path")
    hit = files.where(SCAN_PREFILTER.found(path)).withColumn("hit", classify(path, F.col("language")))
    return hit.where(F.col("hit").isNotNull()).withColumns({"tool": F.col("hit.tool"), "precision": F.col("hit.precision")}).drop("hit")


def is_core(tool: Column) -> Column:
    return ~tool.isin(ADJACENT_TOOLS)


def tool_volume(files: DataFrame, core_only: bool = True) -> DataFrame:
    rows = scanned(files)
    rows = rows.where(is_core(F.col("tool"))) if core_only else rows
    return rows.groupBy("tool", "precision").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), F.count_distinct("repo_path").alias("repos"))


def top(counts: DataFrame, n: int, count: str, *keys: str) -> DataFrame:
    """The n largest counts; equal ones in the order of their keys."""
    return counts.orderBy(F.desc(count), *keys).limit(n)


def languages(files: DataFrame) -> DataFrame:
    return files.groupBy(or_else(F.col("language"), "unknown").alias("language")).agg(F.count(F.lit(1)).alias("files"))


def precisions(files: DataFrame) -> DataFrame:
    return scanned(files).groupBy("tool", "precision").agg(F.count(F.lit(1)).alias("files"))


def licences_of_matched(files: DataFrame) -> DataFrame:
    return scanned(files).groupBy(or_else(F.col("license_type"), "unknown").alias("license")).agg(F.count(F.lit(1)).alias("files"))


def core_star_buckets(files: DataFrame) -> DataFrame:
    repos = scanned(files).where(is_core(F.col("tool"))).groupBy("repo_path").agg(F.max("stars").alias("stars"))
    return repos.groupBy(star_bucket(F.col("stars")).alias("bucket")).agg(F.count(F.lit(1)).alias("repos"))


def scalars(files: DataFrame) -> DataFrame:
    return files.agg(F.count_distinct("repo_path").alias("repos"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), F.count_if("is_vendor").alias("vendor_files"), F.count_distinct("shard").alias("shards"))


def extrapolated(sums: DataFrame, total_shards: int, read_groups: int = 1, all_groups: int = 1) -> DataFrame:
    """Counts scaled from the shards and row groups read to all, cut to whole numbers."""
    factor = F.lit(float(total_shards)) / F.col("shards") * F.lit(float(all_groups) / read_groups)
    return sums.select("*", *[scaled(F.col(c), factor).alias(f"{c}_extrapolated") for c in ("repos", "files", "bytes")])


def validated(files: DataFrame) -> DataFrame:
    """YAML files (by extension or language) with their path class, content kind and generated mark."""
    path = F.col("file_path")
    rows = files.where(YAML_FILE.found(path) | F.coalesce(F.col("language") == "YAML", F.lit(False)))
    return rows.select("repo_path", "pos", "size_bytes", "license_type", F.coalesce(classify(path, F.col("language"))["tool"], F.lit("unclassified")).alias("path_class"), yaml_kind(F.col("content"), path).alias("kind"), looks_generated(F.col("content")).alias("generated"))


def validation_recall(files: DataFrame) -> DataFrame:
    rows = validated(files).groupBy("kind", "path_class").agg(F.count(F.lit(1)).alias("files"))
    return rows.withColumn("pct", share(F.col("files"), "kind"))


def validation_precision(files: DataFrame) -> DataFrame:
    rows = validated(files).where("path_class <> 'unclassified'").groupBy("path_class", "kind").agg(F.count(F.lit(1)).alias("files"))
    return rows.withColumn("pct", share(F.col("files"), "path_class"))


def validation_kinds(files: DataFrame) -> DataFrame:
    return validated(files).groupBy("kind").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"), F.count_if("generated").alias("generated"))


def manifest_licences(files: DataFrame) -> DataFrame:
    return validated(files).where("kind = 'k8s_manifest'").groupBy(or_else(F.col("license_type"), "unknown").alias("license")).agg(F.count(F.lit(1)).alias("files"))


def confirmations(files: DataFrame) -> DataFrame:
    """Terraform and Docker files by path, confirmed by content or not."""
    path = F.col("file_path")
    yaml = YAML_FILE.found(path) | F.coalesce(F.col("language") == "YAML", F.lit(False))
    kind = F.when(path.endswith(".tf"), "terraform").when(F.lower(basename(path)).rlike(r"\A(dockerfile|containerfile)"), "dockerfile")
    rows = files.where(~yaml).withColumn("kind", kind).where("kind is not null")
    sure = F.when(F.col("kind") == "terraform", is_terraform(F.col("content"))).otherwise(is_dockerfile(F.col("content")))
    return rows.groupBy("kind", F.when(sure, "confirmed").otherwise("rejected").alias("verdict")).agg(F.count(F.lit(1)).alias("files"))


def label_evidence(labels: DataFrame) -> DataFrame:
    rows = labels.where("tool is not null")
    return rows.groupBy("tool", "precision", "evidence").agg(F.count(F.lit(1)).alias("files"), F.count_distinct("repo_path", "unit").alias("units"))


def measured(files: DataFrame, labels: DataFrame) -> DataFrame:
    """YAML files with their final label and the parser's verdicts: each text is parsed once, in evenly dealt tasks."""
    path = F.col("file_path")
    yaml = files.where(YAML_FILE.found(path)).select("repo_path", "pos", "file_path", F.coalesce("content", F.lit("")).alias("content"), "size_bytes")
    spread = yaml.repartition(F.col("repo_path"), F.col("pos"))
    rows = spread.select("repo_path", "pos", "file_path", "size_bytes", yaml_facts("content").alias("y"), GO_ACTION.found(F.col("content")).alias("templated"))
    return rows.join(labels.select("repo_path", "pos", "tool"), ["repo_path", "pos"])


def measure_precision(rows: DataFrame) -> DataFrame:
    verdict = None
    for tool, field in ARBITERS:
        word = F.when(F.col(f"y.{field}"), "confirmed").otherwise("unconfirmed")
        verdict = (F if verdict is None else verdict).when(F.col("tool") == tool, word)
    chart = F.lower(basename(F.col("file_path"))).startswith("chart.")
    helm = F.when(chart, F.when(F.col("y.is_chart_meta"), "confirmed_chart_metadata").otherwise("unconfirmed")).when(F.col("templated"), "confirmed_templated").otherwise("chart_member_untemplated")
    verdict = verdict.when(F.col("tool") == "helm", helm)
    return rows.withColumn("verdict", verdict).where("verdict is not null").groupBy("tool", "verdict").agg(F.count(F.lit(1)).alias("files")).withColumn("pct", share(F.col("files"), "tool"))


def measure_recall(rows: DataFrame) -> DataFrame:
    truth = None
    for tool, field in ARBITERS:
        truth = (F if truth is None else truth).when(F.col(f"y.{field}"), tool)
    out = rows.withColumn("truth", truth).where("truth is not null").groupBy("truth", F.coalesce("tool", F.lit("unlabelled")).alias("label")).agg(F.count(F.lit(1)).alias("files"))
    return out.withColumn("pct", share(F.col("files"), "truth"))


def unlabelled_profile(rows: DataFrame) -> DataFrame:
    """What was dropped: first keys, signatures of four keys, base names, unparseable texts, by count and name."""
    keys = F.col("y.top_keys")
    none = F.size(keys) == 0
    facets = F.array(
        F.when(~none, F.struct(F.lit("first_key").alias("facet"), F.get(keys, F.lit(0)).alias("value"))),
        F.when(~none, F.struct(F.lit("signature").alias("facet"), F.array_join(F.array_sort(F.slice(keys, 1, 4)), ",").alias("value"))),
        F.when(none, F.struct(F.lit("unparseable").alias("facet"), F.lit("all").alias("value"))),
        F.when(none & F.col("templated"), F.struct(F.lit("unparseable").alias("facet"), F.lit("templated").alias("value"))),
        F.struct(F.lit("basename").alias("facet"), F.lower(basename(F.col("file_path"))).alias("value")),
    )
    out = rows.where("tool is null").select(F.explode(F.array_compact(facets)).alias("f"))
    return out.groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("files"))


def unlabelled_top(counts: DataFrame) -> DataFrame:
    """The most frequent entries of each facet of an unlabelled profile."""
    most = {"first_key": MOST_KEYS, "signature": MOST_SIGNATURES, "basename": MOST_NAMES, "unparseable": 2}
    parts = [top(counts.where(F.col("facet") == facet), n, "files", "value") for facet, n in most.items()]
    return reduce(DataFrame.unionAll, parts)


def licence_distribution(files: DataFrame) -> DataFrame:
    return files.groupBy(or_else(F.col("license_type"), "null").alias("license")).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))


def detected_licences(files: DataFrame) -> DataFrame:
    return files.select(F.explode("detected_licenses").alias("license")).groupBy("license").agg(F.count(F.lit(1)).alias("files"))


def repo_purity(files: DataFrame) -> DataFrame:
    free = F.coalesce(F.col("license_type") == "permissive", F.lit(False))
    repos = files.groupBy("repo_path").agg(F.count_if(free).alias("free"), F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("free") == F.col("n"), "all_permissive").when(F.col("free") > 0, "mixed").otherwise("none_permissive")
    return repos.groupBy(kind.alias("purity")).agg(F.count(F.lit(1)).alias("repos"))


def licence_propagation(files: DataFrame) -> DataFrame:
    """Repositories by a licence file at their root and by how far their files are labelled."""
    path = F.col("file_path")
    root = ~path.contains("/") & LICENSE_FILE.found(path)
    free = F.coalesce(F.col("license_type") == "permissive", F.lit(False))
    repos = files.groupBy("repo_path").agg(F.coalesce(F.max(root.cast("int")), F.lit(0)).alias("licensed"), F.count_if(free).alias("free"), F.count(F.lit(1)).alias("n"))
    labelled = F.when(F.col("free") == 0, "none").when(F.col("free") == F.col("n"), "fully").otherwise("partly")
    return repos.groupBy((F.col("licensed") == 1).alias("has_license_file"), labelled.alias("labelled")).agg(F.count(F.lit(1)).alias("repos"))
