"""The library's functions by name in SQL, for one session."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .yaml_facts import as_udf


def register(spark: SparkSession) -> None:
    """Adds `yaml_facts(text)` and the table function `gzip_records(bytes)`; path and content rules are columns, to be used as such."""
    from ..sources.gzip_repair import GzipRecords

    spark.udf.register("yaml_facts", as_udf())
    spark.udtf.register("gzip_records", F.udtf(GzipRecords, returnType="member int, seq bigint, truncated boolean, line string"))
