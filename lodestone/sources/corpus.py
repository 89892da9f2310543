"""Reading a corpus of repositories, and one derived from plain document tables.

A repository row nests its files. Spark prunes nested leaves for some plan shapes only, so every
profile passes the read schema it needs: without `content`, some 3 % of a corpus's bytes are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_META = "github_metadata struct<stars: bigint, is_fork: boolean>"
_FILE = "file_path: string, language: string, size_bytes: bigint, license_type: string, is_vendor: boolean, detected_licenses: array<string>"
PROFILES = {
    "repo_only": "repo_path string",
    "metadata": f"repo_path string, commit_id string, {_META}, files array<struct<{_FILE}>>",
    "content": f"repo_path string, commit_id string, {_META}, files array<struct<{_FILE}, content: string>>",
}
REPO = ["repo_path", "commit_id"]
#: Shards of the full corpus, which samples are scaled to.
TOTAL_SHARDS = 8196


def shard_path(root: str, index: Column | int, revision: str = "") -> str:
    """The path of a numbered shard, of a revision or, without one, of the root."""
    base = f"{root.rstrip('/')}/{revision}" if revision else root.rstrip("/")
    return f"{base}/shard-{index:05d}.parquet"


def sample_indices(spark: SparkSession, count: int, total: int = TOTAL_SHARDS) -> DataFrame:
    """Evenly spaced shard numbers; the step is a double, as sums of it decide which numbers come."""
    if count >= total:
        return spark.range(total).select(F.col("id").alias("shard"))
    step = F.lit(float(total) / count) if count > 0 else F.lit(0.0)
    return spark.range(max(0, count)).select(F.floor(F.col("id") * step).cast("bigint").alias("shard")).distinct()


def read_corpus(spark: SparkSession, path: str | list[str], profile: str = "metadata") -> DataFrame:
    """Repositories with exactly a profile's leaves, and the number in each shard file's name."""
    rows = spark.read.schema(PROFILES[profile]).option("ignoreCorruptFiles", "true").parquet(*([path] if isinstance(path, str) else path))
    if profile == "repo_only":
        return rows
    return rows.select("*", shard_number(F.col("_metadata.file_name")).alias("shard"))


def shard_number(file_name: Column) -> Column:
    """The first number in a shard file's name, 0 without one."""
    digits = F.regexp_extract(file_name, r"(\d+)", 1)
    return F.coalesce(F.try_to_number(F.nullif(digits, F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))


def unforked(repos: DataFrame) -> DataFrame:
    """Repositories that are no forks, a missing mark counting as none; on the stored leaf, so that the filter reaches Parquet."""
    fork = F.col("github_metadata.is_fork")
    return repos.where(fork.isNull() | ~fork)


def flatten(repos: DataFrame) -> DataFrame:
    """One row a file, with its place in the repository. Repositories without files vanish."""
    fields = [f.name for f in repos.schema["files"].dataType.elementType.fields]
    stars, fork = F.col("github_metadata.stars"), F.col("github_metadata.is_fork")
    rows = repos.select("repo_path", "commit_id", stars.alias("stars"), F.coalesce(fork, F.lit(False)).alias("is_fork"), "shard", F.posexplode("files").alias("pos", "f"))
    return rows.select("repo_path", "commit_id", "stars", "is_fork", "shard", "pos", *[F.col(f"f.{n}").alias(n) for n in fields])


def without_forks(files: DataFrame) -> DataFrame:
    return files.where(~F.col("is_fork"))


def with_min_stars(files: DataFrame, least: int) -> DataFrame:
    return files.where(F.coalesce("stars", F.lit(0)) >= least)


def row_group_sample(spark: SparkSession, path: str, first: int) -> DataFrame:
    """Which row groups of each Parquet file a limited scan reads, with read and total counts to scale by: (file, row_group, rows, read, total)."""
    groups = footer(spark, path).select("file", "row_group", "rows").distinct()
    per_file = Window.partitionBy("file")
    return groups.select("file", "row_group", "rows", F.sum(F.when(F.col("row_group") < first, 1).otherwise(0)).over(per_file).alias("read"), F.count(F.lit(1)).over(per_file).alias("total")).where(F.col("row_group") < first)


def footer(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_group, rows, leaf, compressed_bytes) from Parquet footers. Spark lists the files; each footer is read on an executor by
    its place at the file's end, and no other byte."""
    from collections.abc import Iterator

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSystem

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file://") else name)
                with store.open_input_file(path) as file:
                    meta = pq.read_metadata(file)
                rows = [(name.rsplit("/", 1)[-1], g, meta.row_group(g).num_rows, c.path_in_schema, c.total_compressed_size) for g in range(meta.num_row_groups) for c in (meta.row_group(g).column(i) for i in range(meta.num_columns))]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.int64())], names=["file", "row_group", "rows", "leaf", "compressed_bytes"])

    files = spark.read.format("binaryFile").load(path).select("path").repartition(8 * spark.sparkContext.defaultParallelism)
    return files.mapInArrow(run, "file string, row_group int, rows bigint, leaf string, compressed_bytes bigint")


def leaf_shares(footers: DataFrame) -> DataFrame:
    """Compressed bytes of each leaf and its percent of all."""
    sums = footers.groupBy("leaf").agg(F.sum("compressed_bytes").alias("compressed_bytes"))
    total = sums.agg(F.sum("compressed_bytes").alias("t")).select("t").scalar()
    return sums.select("leaf", "compressed_bytes", F.round(100 * F.col("compressed_bytes") / total, 2).alias("share_pct"))


def cited_repos(records: DataFrame) -> DataFrame:
    return records.where(F.col("repo_path").isNotNull()).select("repo_path").distinct()


def surviving_repos(revision: DataFrame, cited: DataFrame | None = None) -> DataFrame:
    """Repositories still in a revision, of those cited if given: one column is read, and cited ones only are kept."""
    repos = revision.select("repo_path").distinct()
    return repos if cited is None else repos.join(cited.select("repo_path"), "repo_path", "left_semi")


def remaining_shards(sampled: DataFrame, completed: DataFrame, offset: int = 0) -> DataFrame:
    """Shards of a sample that no run has completed."""
    return sampled.orderBy("shard").offset(offset).join(completed.select("shard"), "shard", "left_anti")


def read_units(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; lines that don't parse keep their text in `_corrupt`."""
    return spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def write_units(units: DataFrame, path: str, run_tag: str) -> None:
    """One folder for each class of a run, compressed; a run's folder can't be opened twice."""
    units.write.mode("errorifexists").partitionBy("unit_type").option("compression", "gzip").json(f"{path}/run={run_tag}")
