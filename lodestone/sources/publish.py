"""Published tables: one declared schema a configuration, and Parquet files of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FILE = "struct<path: string, content: string, license_type: string, detected_licenses: array<string>, size_bytes: int>"
_FLAGS = "file_count: int, total_bytes: int, all_permissive: boolean"
# The fields of quality, and of flags beyond the common ones.
QUALITY = {
    "helm_chart": "templates: int, templated_templates: int, helpers: int, has_values: boolean",
    "terraform_module": "tf_files: int, declaring: int, has_variables: boolean, has_outputs: boolean",
    "manifest_set": "manifests: int, kinds: array<string>",
    "ansible_role": "task_files: int, has_defaults: boolean, has_handlers: boolean, has_templates: boolean",
    "dockerfile": "stages: int, instructions: int, multi_stage: boolean, has_user: boolean, has_healthcheck: boolean",
    "workflow": "jobs: int, steps: int, uses_actions: int, triggers: array<string>, has_permissions: boolean",
    "compose": "services: int, built_services: int, image_only_services: int, has_healthcheck: boolean, has_volumes: boolean, has_networks: boolean",
}
FLAGS = {
    "helm_chart": "self_contained: boolean, references_helpers: boolean, defines_helpers: boolean",
    "dockerfile": "pins_digest: boolean, uses_latest_tag: boolean",
    "workflow": "has_unpinned_action: boolean",
}
CODECS = ("zstd", "snappy", "gzip")
#: Bytes of content that go into one file, before compression.
FILE_BYTES = 450 << 20


def schema_ddl(config: str) -> str:
    """The schema of a configuration; an unknown one is refused."""
    if config not in QUALITY:
        raise ValueError(f"no such configuration: {config}")
    flags = ", ".join([_FLAGS, *([FLAGS[config]] if config in FLAGS else [])])
    return f"unit_type string, repo_path string, commit_id string, stars int, unit_prefix string, shard int, license_types array<string>, files array<{_FILE}>, quality struct<{QUALITY[config]}>, flags struct<{flags}>"


def _conform(column: Column | None, have: T.DataType | None, want: T.DataType, default) -> Column:
    """A column in a declared type: missing fields are null, and defaults fill nulls."""
    if column is None or have is None:
        value = F.lit(None)
    elif isinstance(want, T.StructType) and isinstance(have, T.StructType):
        there = {f.name: f.dataType for f in have.fields}
        value = F.struct(*[_conform(column[f.name] if f.name in there else None, there.get(f.name), f.dataType, None).alias(f.name) for f in want.fields])
    else:
        value = column
    value = value.cast(want)
    return value if default is None else F.coalesce(value, F.lit(default) if not isinstance(default, list) else F.array().cast(want))


def _file_on(have: T.StructType, want: T.StructType):
    inner = {x.name: x.dataType for x in have.fields}
    defaults = {"content": "", "detected_licenses": [], "size_bytes": 0}
    return lambda e: F.struct(*[_conform(e[x.name] if x.name in inner else None, inner.get(x.name), x.dataType, defaults.get(x.name)).alias(x.name) for x in want.fields])


def conformed(units: DataFrame, config: str) -> DataFrame:
    """Units of one class on its schema."""
    want = T._parse_datatype_string(schema_ddl(config))
    have = {f.name: f.dataType for f in units.schema.fields}
    defaults = {"stars": 0, "unit_prefix": "", "license_types": []}
    columns = []
    for f in want.fields:
        if f.name == "files" and "files" in have:
            files = F.transform("files", _file_on(have["files"].elementType, f.dataType.elementType))
            columns.append(files.alias("files"))
        else:
            columns.append(_conform(F.col(f.name) if f.name in have else None, have.get(f.name), f.dataType, defaults.get(f.name)).alias(f.name))
    return units.where(F.col("unit_type") == config).select(*columns)


def write_config(units: DataFrame, config: str, root: str, codec: str = "zstd", file_bytes: int = FILE_BYTES) -> None:
    """data/<config>/ as Parquet: as many files as the measured content needs, dealt evenly."""
    if codec not in CODECS:
        raise ValueError(f"no such codec: {codec}")
    rows = conformed(units, config)
    total = rows.agg(F.coalesce(F.sum("flags.total_bytes"), F.lit(0))).first()[0]
    rows.repartition(max(1, -(-int(total) // file_bytes))).write.mode("overwrite").option("compression", codec).parquet(f"{root}/data/{config}")


def published_stats(root: str, spark, configs: list[str]) -> list[dict]:
    """Rows, files and bytes of each written configuration, counted from what is there."""
    out = []
    for config in configs:
        path = f"{root}/data/{config}"
        files = spark.read.format("binaryFile").load(path).select("path", "length")
        row = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
        out.append({"config": config, "rows": spark.read.parquet(path).count(), "files": row.files, "bytes": row.bytes})
    return out
