"""From extracted units to publishable ones: opt-outs go, repeated files go, counts are taken again, flags are derived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.detectors import API_VERSION, KIND, is_terraform
from ..functions.dialect import Pattern

# What the flags look for.
INCLUDE = Pattern(r'\{\{-?\s*(include|template)\s+"')
DEFINE = Pattern(r'\{\{-?\s*define\s+"')
DIGEST_PIN = Pattern(r"^\s*+FROM\s+\S+@sha256:", "mi")
LATEST = Pattern(r"^\s*+FROM\s+\S+:latest\b", "mi")
UNPINNED = Pattern(r"uses:\s*\S+@(?:v?\d+|main|master)\s*$", "m")
SINGLE_CLASSES = ("dockerfile", "workflow", "compose")


def kept(units: DataFrame, surviving: DataFrame | None) -> DataFrame:
    """Units of surviving repositories; all of them when no list is given."""
    return units if surviving is None else units.join(surviving.select("repo_path").distinct(), "repo_path", "left_semi")


def dropped(units: DataFrame, surviving: DataFrame) -> DataFrame:
    return units.join(surviving.select("repo_path").distinct(), "repo_path", "left_anti")


def dedupe_files(files: Column) -> Column:
    """Of files with equal path and content the first; null counts as empty. Units hold 60 files at most, so this stays in the row."""
    keys = F.transform(files, lambda f: F.struct(F.coalesce(f["path"], F.lit("")).alias("p"), F.coalesce(f["content"], F.lit("")).alias("c")))
    return F.filter(files, lambda f, i: F.array_position(keys, F.get(keys, i)) == i + 1)


def unit_relative(path: Column, prefix: Column, unit_type: Column) -> Column:
    below = F.when((prefix != "") & F.startswith(path, F.concat(prefix, F.lit("/"))), F.substr(path, F.length(prefix) + 2)).otherwise(path)
    return F.when(unit_type.isin(*SINGLE_CLASSES), F.element_at(F.split(path, "/"), -1)).otherwise(below)


def _entries() -> Column:
    prefix = F.coalesce("unit_prefix", F.lit(""))
    return F.transform("files", lambda f: F.struct(unit_relative(F.coalesce(f["path"], F.lit("")), prefix, F.col("unit_type")).alias("name"), F.coalesce(f["content"], F.lit("")).alias("content")))


def recounted(units: DataFrame) -> DataFrame:
    """Adds `counts` (class by class, from entries) and `reason`: '' or why a unit no longer holds. YAML is not parsed again: only copies have gone."""
    rows = units.withColumn("_e", _entries())
    low = lambda e: F.lower(e["name"])
    is_yaml = lambda e: low(e).rlike(r"\.ya?ml\z")
    some = lambda test: F.exists("_e", test)
    many = lambda test: F.size(F.filter("_e", test))
    template = lambda e: low(e).startswith("templates/") & is_yaml(e)
    tf = lambda e: e["name"].endswith(".tf")
    task = lambda e: low(e).startswith("tasks/") & is_yaml(e)
    top = lambda name: some(lambda e: F.element_at(F.split(low(e), "/"), 1) == name)
    counts = F.struct(
        many(template).alias("templates"), many(lambda e: template(e) & e["content"].contains("{{")).alias("templated_templates"),
        many(lambda e: low(e).endswith(".tpl")).alias("helpers"), some(lambda e: low(e).startswith("values")).alias("has_values"),
        many(tf).alias("tf_files"), many(lambda e: tf(e) & is_terraform(e["content"])).alias("declaring"),
        some(lambda e: tf(e) & low(e).contains("variable")).alias("has_variables"), some(lambda e: tf(e) & low(e).contains("output")).alias("has_outputs"),
        many(lambda e: API_VERSION.found(e["content"]) & KIND.found(e["content"])).alias("manifests"),
        many(task).alias("task_files"), top("defaults").alias("has_defaults"), top("handlers").alias("has_handlers"), top("templates").alias("has_templates"),
    )
    kind, c = F.col("unit_type"), lambda name: F.col(f"counts.{name}")
    reason = (
        F.when((kind == "helm_chart") & (c("templates") < 2), "too_few_templates")
        .when((kind == "helm_chart") & (c("templated_templates") == 0), "no_templating")
        .when((kind == "terraform_module") & (c("tf_files") < 2), "too_few_tf_files")
        .when((kind == "manifest_set") & (c("manifests") < 2), "too_few_manifests")
        .when((kind == "ansible_role") & (c("task_files") == 0), "no_tasks")
        .otherwise("")
    )
    return rows.withColumn("counts", counts).withColumn("reason", reason).drop("_e")


#: Quality fields that are taken anew, by class; other fields stay.
RECOUNTED = {
    "helm_chart": ["templates", "templated_templates", "helpers", "has_values"],
    "terraform_module": ["tf_files", "declaring", "has_variables", "has_outputs"],
    "manifest_set": ["manifests"],
    "ansible_role": ["task_files", "has_defaults", "has_handlers", "has_templates"],
}


def with_quality(rows: DataFrame, unit_type: str) -> DataFrame:
    """One class's rows with the recounted fields in quality, and without quality.files."""
    if "quality" not in rows.columns:
        return rows.withColumn("quality", F.struct(*[F.col(f"counts.{n}").alias(n) for n in RECOUNTED.get(unit_type, [])] or [F.lit(None).cast("int").alias("none")])).drop("counts")
    names = [f.name for f in rows.schema["quality"].dataType.fields if f.name != "files"]
    new = RECOUNTED.get(unit_type, [])
    return rows.withColumn("quality", F.struct(*[(F.col(f"counts.{n}") if n in new else F.col(f"quality.{n}")).alias(n) for n in names])).drop("counts")


def flags(unit_type: str) -> Column:
    """The flags of a class. Contents are tested file by file."""
    content = lambda f: F.coalesce(f["content"], F.lit(""))
    has = lambda p: F.exists("files", lambda f: p.found(content(f)))
    total = F.aggregate("files", F.lit(0).cast("bigint"), lambda a, f: a + F.length(content(f)))
    licences = F.coalesce("license_types", F.array().cast("array<string>"))
    fields = [F.size("files").alias("file_count"), total.cast("int").alias("total_bytes"), ((F.size(licences) > 0) & F.forall(licences, lambda x: F.coalesce(x == "permissive", F.lit(False)))).alias("all_permissive")]
    if unit_type == "helm_chart":
        fields += [(has(DEFINE) | ~has(INCLUDE)).alias("self_contained"), has(INCLUDE).alias("references_helpers"), has(DEFINE).alias("defines_helpers")]
    elif unit_type == "dockerfile":
        fields += [has(DIGEST_PIN).alias("pins_digest"), has(LATEST).alias("uses_latest_tag")]
    elif unit_type == "workflow":
        fields += [has(UNPINNED).alias("has_unpinned_action")]
    return F.struct(*fields)


def finalized(units: DataFrame, unit_type: str, surviving: DataFrame | None = None) -> DataFrame:
    """One class through all steps; `reason` is '' for units to publish, `removed` counts their repeated files."""
    rows = kept(units.where(F.col("unit_type") == unit_type), surviving)
    rows = rows.withColumn("_n", F.size("files")).withColumn("files", dedupe_files(F.col("files"))).withColumn("removed", F.col("_n") - F.size("files")).drop("_n")
    return with_quality(recounted(rows), unit_type).withColumn("flags", flags(unit_type))


def finalize_stats(units: DataFrame, unit_type: str, surviving: DataFrame | None = None) -> DataFrame:
    """The counters of one class in one row, from one grouped pass."""
    own = units.where(F.col("unit_type") == unit_type)
    corrupt = F.col("_corrupt").isNotNull() if "_corrupt" in units.columns else F.lit(False)
    read = own.agg(F.count_if(~corrupt).alias("read"), F.count_if(corrupt).alias("unparseable"))
    done = finalized(own, unit_type, surviving)
    good = F.col("reason") == ""
    contained = F.col("flags.self_contained") if unit_type == "helm_chart" else F.lit(True)
    sums = done.agg(
        F.count(F.lit(1)).alias("kept"), F.count_if(F.col("removed") > 0).alias("units_with_duplicates"), F.coalesce(F.sum("removed"), F.lit(0)).alias("duplicate_files_removed"),
        F.count_if(~good).alias("dropped_after_dedup"), F.count_if(good & ~contained).alias("charts_not_self_contained"), F.count_if(good).alias("written"),
    )
    one = lambda df, name: df.select(name).scalar()
    return read.select(
        F.lit(unit_type).alias("unit_type"), "read", "unparseable", (F.col("read") - one(sums, "kept")).alias("dropped_opted_out"),
        *[one(sums, n).alias(n) for n in ("units_with_duplicates", "duplicate_files_removed", "dropped_after_dedup", "charts_not_self_contained", "written")],
    )
