"""Quality gates: from a unit's files to passed, a reason, and counts. Every verdict is an aggregate over narrow per-file facts; contents follow for survivors only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.detectors import DOCKER_INSTRUCTION, is_dockerfile, is_terraform, looks_generated
from ..functions.path_rules import YAML_OR_TEMPLATE
from ..functions.yaml_facts import NOTHING, SCHEMA, yaml_facts
from .candidates import UNIT

MOST_FILES, MOST_BYTES, MOST_CHARS = 60, 2 * 1024 * 1024, 262_144
LINES = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"
MOST_KINDS = 12


def lines(text: Column) -> Column:
    return F.split(text, LINES)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def file_facts(files: DataFrame, members: DataFrame) -> DataFrame:
    """(repo_path, pos, facts) of every file of any candidate, each parsed and measured once. YAML goes through Python, nothing else does."""
    c = F.coalesce(F.col("content"), F.lit(""))
    own = lines(c)
    trimmed = F.transform(own, lambda x: F.upper(stripped(x)))
    starts = lambda word: lambda x: F.startswith(x, F.lit(word))
    kind_lines = F.transform(F.filter(own, starts("kind:")), lambda x: stripped(F.substr(x, F.lit(6))))
    picked = files.join(members.select("repo_path", "pos").distinct(), ["repo_path", "pos"], "left_semi").select("repo_path", "pos", "file_path", "content")
    plain = picked.select(
        "repo_path",
        "pos",
        F.length(c).alias("chars"),
        F.octet_length(c).alias("bytes"),
        c.contains("{{").alias("braces"),
        is_terraform(F.col("content")).alias("declares"),
        looks_generated(F.col("content")).alias("generated"),
        is_dockerfile(F.col("content")).alias("docker"),
        F.size(F.filter(trimmed, starts("FROM "))).alias("stages"),
        F.size(F.filter(own, lambda x: stripped(x).rlike(DOCKER_INSTRUCTION.java.replace("^", r"\A")))).alias("instructions"),
        F.exists(trimmed, starts("USER ")).alias("has_user"),
        F.exists(trimmed, starts("HEALTHCHECK")).alias("docker_healthcheck"),
        F.array_distinct(kind_lines).alias("kind_names"),
        F.when(YAML_OR_TEMPLATE.found(F.col("file_path")), c).alias("yaml_text"),
    )
    none = F.from_json(F.lit(json.dumps(NOTHING)), SCHEMA)
    yaml = plain.where("yaml_text is not null").select(*[x for x in plain.columns if x != "yaml_text"], yaml_facts("yaml_text").alias("y"))
    other = plain.where("yaml_text is null").select(*[x for x in plain.columns if x != "yaml_text"], none.alias("y"))
    return yaml.unionAll(other)


def bounds() -> Column:
    """What is wrong with a unit's size, in order; null if nothing is. Over aggregates n, all_bytes, longest."""
    return (
        F.when(F.col("n") == 0, "empty")
        .when(F.col("n") > MOST_FILES, "too_many_files")
        .when(F.col("all_bytes") > MOST_BYTES, "unit_too_large")
        .when(F.col("longest") > MOST_CHARS, "file_too_large")
    )


def verdict(rows: DataFrame, reason: Column, quality: dict[str, Column]) -> DataFrame:
    """UNIT columns, passed, reason ('' if passed), quality (null if rejected)."""
    reasons = F.coalesce(bounds(), reason, F.lit(""))
    fields = F.struct(*[v.alias(k) for k, v in {**quality, "files": F.col("n").cast("int")}.items()])
    return rows.withColumn("reason", reasons).select(*UNIT, (F.col("reason") == "").alias("passed"), "reason", F.when(F.col("reason") == "", fields).alias("quality"))


def _sizes() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("all_bytes"), F.max("chars").alias("longest")]


def _of(members: DataFrame, facts: DataFrame, unit_type: str) -> DataFrame:
    return members.where(F.col("unit_type") == unit_type).join(facts, ["repo_path", "pos"])


def _any(condition: Column) -> Column:
    return F.coalesce(F.max(condition.cast("int")), F.lit(0)) == 1


def _int(n: Column) -> Column:
    return n.cast("int")


def gate_helm_chart(members: DataFrame, facts: DataFrame) -> DataFrame:
    rows = _of(members, facts, "helm_chart")
    # Files with one relative name count as one, the last; sizes count every file.
    names = rows.groupBy(*UNIT, "relative").agg(*_sizes(), F.min("pos").alias("first"), F.max_by(F.struct("braces", "y.is_chart_meta"), "pos").alias("last"))
    low = F.lower("relative")
    template = low.startswith("templates/") & low.rlike(r"\.ya?ml\z")
    chart = low.isin("chart.yaml", "chart.yml")
    units = names.groupBy(*UNIT).agg(
        F.sum("n").alias("n"), F.sum("all_bytes").alias("all_bytes"), F.max("longest").alias("longest"),
        F.min_by(F.when(chart, F.col("last.is_chart_meta")), F.when(chart, F.col("first"))).alias("chart"),
        F.count_if(template).alias("templates"), F.count_if(template & F.col("last.braces")).alias("templated"),
        _any(low.startswith("values")).alias("has_values"), F.count_if(low.endswith(".tpl")).alias("helpers"),
    )
    reason = F.when(F.col("chart").isNull(), "no_chart_metadata").when(~F.col("chart"), "unparseable_chart_metadata").when(F.col("templates") < 2, "too_few_templates").when(F.col("templated") == 0, "no_templating")
    return verdict(units, reason, {"templates": _int(F.col("templates")), "templated_templates": _int(F.col("templated")), "has_values": F.col("has_values"), "helpers": _int(F.col("helpers"))})


def gate_terraform_module(members: DataFrame, facts: DataFrame) -> DataFrame:
    tf, low = F.col("relative").endswith(".tf"), F.lower("relative")
    units = _of(members, facts, "terraform_module").groupBy(*UNIT).agg(
        *_sizes(), F.count_if(tf).alias("tf"), F.count_if(tf & F.col("declares")).alias("declaring"), F.count_if(tf & F.col("generated")).alias("generated"),
        _any(tf & low.contains("variable")).alias("has_variables"), _any(tf & low.contains("output")).alias("has_outputs"),
    )
    reason = F.when(F.col("tf") < 2, "too_few_tf_files").when(F.col("declaring") == 0, "no_declarations").when(F.col("generated") == F.col("tf"), "generated")
    return verdict(units, reason, {"tf_files": _int(F.col("tf")), "declaring": _int(F.col("declaring")), "has_variables": F.col("has_variables"), "has_outputs": F.col("has_outputs")})


def gate_ansible_role(members: DataFrame, facts: DataFrame) -> DataFrame:
    low = F.lower("relative")
    task, top = low.startswith("tasks/") & low.rlike(r"\.ya?ml\z"), F.element_at(F.split(low, "/"), 1)
    units = _of(members, facts, "ansible_role").groupBy(*UNIT).agg(
        *_sizes(), F.count_if(task).alias("tasks"), _any(task & F.col("y.is_ansible")).alias("verified"),
        *[_any(top == d).alias(f"has_{d}") for d in ("defaults", "handlers", "templates")],
    )
    reason = F.when(F.col("tasks") == 0, "no_tasks").when(~F.col("verified"), "unverified_tasks")
    return verdict(units, reason, {"task_files": _int(F.col("tasks"))} | {f"has_{d}": F.col(f"has_{d}") for d in ("defaults", "handlers", "templates")})


def gate_manifest_set(members: DataFrame, facts: DataFrame) -> DataFrame:
    units = _of(members, facts, "manifest_set").groupBy(*UNIT).agg(
        *_sizes(), F.count_if("y.is_k8s").alias("manifests"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("y.is_k8s"), F.col("kind_names"))))).alias("kinds"),
    )
    reason = F.when(F.col("manifests") < 2, "too_few_manifests")
    return verdict(units, reason, {"manifests": _int(F.col("manifests")), "kinds": F.slice(F.array_sort("kinds"), 1, MOST_KINDS)})


def _single(members: DataFrame, facts: DataFrame, unit_type: str) -> DataFrame:
    rows = _of(members, facts, unit_type)
    return rows.withColumns({"n": F.lit(1), "all_bytes": F.col("bytes"), "longest": F.col("chars")})


def gate_dockerfile(members: DataFrame, facts: DataFrame) -> DataFrame:
    reason = F.when(~F.col("docker"), "not_a_dockerfile").when(F.col("generated"), "generated")
    quality = {"stages": F.col("stages"), "multi_stage": F.col("stages") > 1, "instructions": F.col("instructions"), "has_user": F.col("has_user"), "has_healthcheck": F.col("docker_healthcheck")}
    return verdict(_single(members, facts, "dockerfile"), reason, quality)


def gate_workflow(members: DataFrame, facts: DataFrame) -> DataFrame:
    quality = {k: F.col(f"y.{k}") for k in ("jobs", "steps", "uses_actions", "triggers", "has_permissions")}
    return verdict(_single(members, facts, "workflow"), F.when(~F.col("y.is_gha"), "unverified_workflow"), quality)


def gate_compose(members: DataFrame, facts: DataFrame) -> DataFrame:
    quality = {"services": F.col("y.services"), "built_services": F.col("y.built_services"), "image_only_services": F.col("y.services") - F.col("y.built_services")}
    quality |= {k: F.col(f"y.{k}") for k in ("has_volumes", "has_networks", "has_healthcheck")}
    return verdict(_single(members, facts, "compose"), F.when(~F.col("y.is_compose"), "unverified_compose"), quality)


GATES = {
    "helm_chart": gate_helm_chart,
    "terraform_module": gate_terraform_module,
    "ansible_role": gate_ansible_role,
    "manifest_set": gate_manifest_set,
    "dockerfile": gate_dockerfile,
    "workflow": gate_workflow,
    "compose": gate_compose,
}


def all_verdicts(members: DataFrame, facts: DataFrame) -> DataFrame:
    """UNIT, passed, reason of every class."""
    out = None
    for gate in GATES.values():
        rows = gate(members, facts).select(*UNIT, "passed", "reason")
        out = rows if out is None else out.unionAll(rows)
    return out


def rejections(verdicts: DataFrame) -> DataFrame:
    """Per class: candidates, extracted and pass rate; and a row for each reason."""
    rows = verdicts.groupBy("unit_type", "reason").agg(F.count(F.lit(1)).alias("units"))
    total = F.sum("units").over(Window.partitionBy("unit_type"))
    return rows.select("unit_type", F.when(F.col("reason") == "", "extracted").otherwise(F.col("reason")).alias("outcome"), "units", F.round(100 * F.col("units") / total, 2).alias("pct"))


def unit_records(files: DataFrame, members: DataFrame, verdict_rows: DataFrame) -> DataFrame:
    """Records of units that passed one gate: provenance, quality, and their files in order. Contents join for survivors only, 60 files a unit at most."""
    kept = members.join(verdict_rows.where("passed").select(*UNIT, "quality"), UNIT)
    body = files.select("repo_path", "pos", "commit_id", "stars", "shard", "license_type", "detected_licenses", "content")
    c = F.coalesce(F.col("content"), F.lit(""))
    entry = F.struct("pos", F.col("file_path").alias("path"), c.alias("content"), "license_type", "detected_licenses", F.length(c).alias("size_bytes"))
    rows = kept.join(body, ["repo_path", "pos"]).groupBy(*UNIT).agg(
        F.first("commit_id").alias("commit_id"), F.first("stars").cast("int").alias("stars"), F.first("shard").alias("shard"),
        F.array_sort(F.collect_set(F.coalesce("license_type", F.lit("unknown")))).alias("license_types"), F.first("quality").alias("quality"),
        F.array_sort(F.collect_list(entry)).alias("files"),
    )
    files_out = F.transform("files", lambda f: F.struct(f["path"].alias("path"), f["content"].alias("content"), f["license_type"].alias("license_type"), f["detected_licenses"].alias("detected_licenses"), f["size_bytes"].alias("size_bytes")))
    return rows.select("unit_type", "repo_path", "commit_id", "stars", F.col("prefix").alias("unit_prefix"), "shard", "license_types", "quality", files_out.alias("files"))
