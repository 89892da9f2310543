"""Tables in the folder that all executors share, for results that several plans read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df under spark.checkpoint.dir and reads it again; a folder of our own serves only where that is unset."""
    spark = df.sparkSession
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("lodestone.shared.dir", "")
    if not folder:
        folder = tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("lodestone.shared.dir", folder)
    path = f"{folder.rstrip('/')}/lodestone/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(table: DataFrame) -> None:
    """Takes a stored table away once nothing reads it any more, in whatever store it is."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
