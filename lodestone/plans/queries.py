"""Every operator as a query over the tables, run on the corpus derived from `documents`."""

from __future__ import annotations

import gzip
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import detectors, scalars
from ..functions.path_rules import NOISE, SCAN_PREFILTER, UNIT_PREFILTER, classify
from ..operators import candidates as cand
from ..operators import finalize, gates, profile, reports, units
from ..operators.resolve import labelled
from ..sources import card, corpus, gzip_repair, publish
from ..sources.shared import stored
from ..sources.virtual import virtual_files
from ..streaming.incremental import extracted

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[f.__name__] = f
    return f


def _meta(spark: SparkSession, sf: str) -> DataFrame:
    return virtual_files(spark, sf, content=False)


@query
def scan_tool_volume(spark, sf):
    return reports.tool_volume(_meta(spark, sf))


@query
def scan_languages(spark, sf):
    return reports.languages(_meta(spark, sf))


@query
def scan_top_languages(spark, sf):
    return reports.top(reports.languages(_meta(spark, sf)), 6, "files", "language")


@query
def scan_precision(spark, sf):
    return reports.precisions(_meta(spark, sf))


@query
def scan_licenses(spark, sf):
    return reports.licences_of_matched(_meta(spark, sf))


@query
def scan_star_buckets(spark, sf):
    return reports.core_star_buckets(_meta(spark, sf))


@query
def scan_scalars_extrapolated(spark, sf):
    return reports.extrapolated(reports.scalars(_meta(spark, sf)), corpus.TOTAL_SHARDS, 3, 4)


@query
def classify_paths(spark, sf):
    files = _meta(spark, sf)
    c = classify(F.col("file_path"), F.col("language"))
    return files.select("repo_path", "pos", "file_path", c["tool"].alias("tool"), c["precision"].alias("precision"))


@query
def path_gates(spark, sf):
    p = F.col("file_path")
    return _meta(spark, sf).select("repo_path", "pos", NOISE.found(p).alias("noise"), SCAN_PREFILTER.found(p).alias("scan_gate"), UNIT_PREFILTER.found(p).alias("unit_gate"))


@query
def path_scalars(spark, sf):
    url = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.regexp_replace("url", r"^[a-z]+://", "").alias("path"))
    p = F.col("path")
    return url.select("page_id", scalars.dirname(p).alias("dir"), scalars.basename(p).alias("base"), scalars.relative(p, F.split(p, "/")[0]).alias("rest"), scalars.safe_segments(p).alias("safe"))


@query
def content_kinds(spark, sf):
    c, p = F.col("content"), F.col("file_path")
    return virtual_files(spark, sf).select("repo_path", "pos", detectors.yaml_kind(c, p).alias("kind"), detectors.is_terraform(c).alias("terraform"), detectors.is_dockerfile(c).alias("docker"), detectors.looks_generated(c).alias("generated"))


@query
def detect_units(spark, sf):
    return units.detect_units(_meta(spark, sf))


@query
def unit_repos(spark, sf):
    return units.unit_counts(_meta(spark, sf))


@query
def resolve_labels(spark, sf):
    return labelled(virtual_files(spark, sf))


@query
def label_evidence(spark, sf):
    return reports.label_evidence(labelled(virtual_files(spark, sf)))


@query
def validate_recall(spark, sf):
    return reports.validation_recall(virtual_files(spark, sf))


@query
def validate_precision(spark, sf):
    return reports.validation_precision(virtual_files(spark, sf))


@query
def validate_kinds(spark, sf):
    return reports.validation_kinds(virtual_files(spark, sf))


@query
def validate_confirmations(spark, sf):
    return reports.confirmations(virtual_files(spark, sf))


def _measured(spark, sf):
    files = virtual_files(spark, sf)
    return reports.measured(files, labelled(files))


@query
def measure_precision(spark, sf):
    return reports.measure_precision(_measured(spark, sf))


@query
def measure_recall(spark, sf):
    return reports.measure_recall(_measured(spark, sf))


@query
def non_infra_keys(spark, sf):
    return reports.unlabelled_profile(_measured(spark, sf))


@query
def unit_candidates(spark, sf):
    files = _meta(spark, sf)
    return cand.directory_units(files, units.detect_units(files))


@query
def single_file_units(spark, sf):
    return cand.single_files(labelled(virtual_files(spark, sf, repeats=True)))


@query
def manifest_sets(spark, sf):
    return cand.manifest_sets(labelled(virtual_files(spark, sf, repeats=True)))


def _members(spark, sf):
    files = virtual_files(spark, sf)
    members = stored(cand.candidates(files, labelled(files)), "members")
    return files, members, gates.file_facts(files, members)


def _flat(verdicts: DataFrame) -> DataFrame:
    fields = verdicts.schema["quality"].dataType.fields
    flat = [F.array_join(F.col(f"quality.{f.name}"), ",").alias(f.name) if "array" in f.dataType.simpleString() else F.col(f"quality.{f.name}").alias(f.name) for f in fields]
    return verdicts.select("repo_path", "prefix", "passed", "reason", *flat)


def _gate_query(unit_type: str) -> None:
    def run(spark, sf):
        _, members, facts = _members(spark, sf)
        return _flat(gates.GATES[unit_type](members, facts))

    QUERIES[f"gate_{unit_type}"] = run


for _t in gates.GATES:
    _gate_query(_t)


@query
def rejection_histogram(spark, sf):
    _, members, facts = _members(spark, sf)
    return gates.rejections(gates.all_verdicts(members, stored(facts, "facts")))


def _surviving(files: DataFrame) -> DataFrame:
    """Repositories of a later revision: every fifth organisation has opted out."""
    return files.where(~F.col("repo_path").startswith("org3/")).select("repo_path")


@query
def optout_keep(spark, sf):
    files = _meta(spark, sf)
    return finalize.kept(files, _surviving(files)).groupBy("repo_path").agg(F.count(F.lit(1)).alias("files"))


@query
def optout_dropped(spark, sf):
    files = _meta(spark, sf)
    return finalize.dropped(files, _surviving(files)).groupBy("repo_path").agg(F.count(F.lit(1)).alias("files"))


@query
def surviving_cited(spark, sf):
    files = _meta(spark, sf)
    return corpus.surviving_repos(_surviving(files), corpus.cited_repos(files.where("stars > 5000")))


@query
def resume_shards(spark, sf):
    return corpus.remaining_shards(corpus.sample_indices(spark, 100), spark.range(0, corpus.TOTAL_SHARDS, 3).select(F.col("id").alias("shard")), 5)


@query
def sample_indices(spark, sf):
    return corpus.sample_indices(spark, 198)


def _directory_records(spark, sf) -> DataFrame:
    """Units of directories with their files, ungated, over a corpus with repeated rows: what the finalize steps work on."""
    files = virtual_files(spark, sf, repeats=True)
    members = cand.directory_units(files, units.detect_units(files))
    entry = F.struct("pos", F.col("file_path").alias("path"), "content", "license_type", F.length("content").alias("size_bytes"))
    rows = members.join(files.drop("file_path").withColumnRenamed("repo_path", "r").withColumnRenamed("pos", "p"), (F.col("repo_path") == F.col("r")) & (F.col("pos") == F.col("p")))
    return rows.groupBy("unit_type", "repo_path", F.col("prefix").alias("unit_prefix")).agg(F.array_sort(F.collect_list(entry)).alias("files"), F.array_sort(F.collect_set("license_type")).alias("license_types"), F.first("stars").alias("stars"))


@query
def dedupe_files(spark, sf):
    rows = _directory_records(spark, sf).withColumn("kept", finalize.dedupe_files(F.col("files")))
    return rows.select("unit_type", "repo_path", "unit_prefix", F.size("files").alias("files"), F.size("kept").alias("kept"), F.array_join(F.transform("kept", lambda f: f["pos"].cast("string")), ",").alias("positions"))


@query
def recount_units(spark, sf):
    rows = _directory_records(spark, sf).withColumn("files", finalize.dedupe_files(F.col("files")))
    return finalize.recounted(rows).select("unit_type", "repo_path", "unit_prefix", "reason", "counts.templates", "counts.templated_templates", "counts.helpers", "counts.tf_files", "counts.declaring", "counts.manifests", "counts.task_files", "counts.has_values", "counts.has_defaults")


@query
def derived_flags(spark, sf):
    rows = _directory_records(spark, sf).where("unit_type = 'helm_chart'")
    return rows.select("repo_path", "unit_prefix", finalize.flags("helm_chart").alias("f")).select("repo_path", "unit_prefix", "f.*")


@query
def dockerfile_flags(spark, sf):
    files = virtual_files(spark, sf).where("language = 'Dockerfile'")
    one = files.select("repo_path", "pos", F.array(F.struct("content")).alias("files"), F.array("license_type").alias("license_types"))
    return one.select("repo_path", "pos", finalize.flags("dockerfile").alias("f")).select("repo_path", "pos", "f.*")


@query
def workflow_flags(spark, sf):
    files = virtual_files(spark, sf).where("file_path like '.github/workflows/%'")
    one = files.select("repo_path", "pos", F.array(F.struct("content")).alias("files"), F.array("license_type").alias("license_types"))
    return one.select("repo_path", "pos", finalize.flags("workflow").alias("f")).select("repo_path", "pos", "f.*")


@query
def finalize_stats(spark, sf):
    rows = _directory_records(spark, sf)
    return finalize.finalize_stats(rows, "helm_chart", _surviving(_meta(spark, sf))).unionAll(finalize.finalize_stats(rows, "terraform_module", _surviving(_meta(spark, sf))))


@query
def license_distribution(spark, sf):
    return reports.licence_distribution(_meta(spark, sf))


@query
def detected_licenses(spark, sf):
    return reports.detected_licences(_meta(spark, sf))


@query
def repo_purity(spark, sf):
    return reports.repo_purity(_meta(spark, sf))


@query
def license_propagation(spark, sf):
    return reports.licence_propagation(_meta(spark, sf))


@query
def class_profile(spark, sf):
    return profile.class_profile(_directory_records(spark, sf))


@query
def license_tally(spark, sf):
    return profile.licence_tally(_directory_records(spark, sf))


@query
def star_tally(spark, sf):
    return profile.star_tally(_directory_records(spark, sf))


@query
def numeric_profile(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_returnflag").alias("unit_type"), F.col("l_quantity").cast("bigint").alias("quantity"))
    return profile.numeric_profile(lines, "unit_type", "quantity")


@query
def reservoir_sample(spark, sf):
    return profile.stable_sample(_directory_records(spark, sf), 3).select("unit_type", "repo_path", "unit_prefix")


@query
def materialised_paths(spark, sf):
    return profile.materialised_paths(_directory_records(spark, sf)).select("unit_type", "repo_path", "unit_prefix", "target", F.length("content").cast("bigint").alias("chars"))


@query
def extract_units(spark, sf):
    """All classes of extracted records, counted: the whole path from files to gated units."""
    out = None
    for records in extracted(virtual_files(spark, sf)).values():
        rows = records.select("unit_type", "repo_path", "unit_prefix", F.size("files").alias("files"), F.array_join("license_types", ",").alias("license_types"))
        out = rows if out is None else out.unionAll(rows)
    return out


@query
def publish_schema_roundtrip(spark, sf):
    """One class on its declared schema, with nulls and defaults where nothing was."""
    rows = publish.conformed(finalize.finalized(_directory_records(spark, sf), "helm_chart").where("reason = ''"), "helm_chart")
    return rows.select("unit_type", "repo_path", "unit_prefix", "stars", "commit_id", F.size("files").alias("files"), "quality.templates", "flags.file_count", "flags.self_contained")


@query
def card_totals(spark, sf):
    """A rollup of classes, as the card shows them."""
    rows = _directory_records(spark, sf)
    stats = rows.groupBy(F.col("unit_type").alias("config")).agg(F.count(F.lit(1)).alias("rows"), F.lit(1).cast("bigint").alias("files"), F.sum(F.aggregate("files", F.lit(0).cast("bigint"), lambda a, f: a + f["size_bytes"])).alias("bytes"))
    removed = rows.groupBy("unit_type").agg(F.sum(F.size("files") - F.size(finalize.dedupe_files(F.col("files")))).alias("duplicate_files_removed"), F.lit(0).cast("bigint").alias("charts_not_self_contained"))
    return card.totals(stats, removed)


@query
def record_dedup(spark, sf):
    """Unit keys with repeats, the first of each kept."""
    files = _meta(spark, sf)
    rows = files.unionAll(files.where("pos % 5 = 0"))
    line = F.to_json(F.struct("repo_path", F.col("file_path").alias("unit_prefix"), F.lit("file").alias("unit_type"), "commit_id", "shard"))
    salvage = rows.select(F.lit("all").alias("name"), F.col("pos").alias("member"), F.col("shard").cast("bigint").alias("seq"), F.lit(False).alias("truncated"), line.alias("line"))
    return gzip_repair.records(salvage).groupBy("repo_path").agg(F.count_if(F.col("first")).alias("kept"), F.count_if(~F.col("first")).alias("repeats"))


@query
def repair_gzip(spark, sf):
    """Gzip files damaged on purpose: whole, cut in the middle, cut and whole, and one line over two members."""
    records = [f'{{"repo_path":"r{i}","unit_prefix":"","unit_type":"t","commit_id":"c","shard":{i % 2}}}\n'.encode() for i in range(40)]
    one, two = gzip.compress(b"".join(records[:20])), gzip.compress(b"".join(records[15:]))
    half = b"".join(records)
    files = [("whole", one), ("cut", one[: len(one) // 2]), ("cut_whole", one[: len(one) // 2] + two), ("split", gzip.compress(half[:300]) + gzip.compress(half[300:])), ("empty", b"")]
    return gzip_repair.counters(gzip_repair.salvaged(spark.createDataFrame(files, "name string, bytes binary")))


@query
def footer_shares(spark, sf):
    return corpus.leaf_shares(corpus.footer(spark, f"{sf}/lineitem.parquet"))


@query
def row_group_sample(spark, sf):
    return corpus.row_group_sample(spark, f"{sf}/lineitem.parquet", 1).select("row_group", "rows", "read", "total")
