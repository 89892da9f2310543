"""Incremental extraction: corpus files that have come since the last run, by a file stream that stops when it has caught up.

The checkpoint is the run's state: a file is taken once, and Spark's commit makes each batch's output appear once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.candidates import candidates
from ..operators.gates import GATES, file_facts, unit_records
from ..operators.resolve import labelled
from ..operators.units import detect_units
from ..sources.corpus import PROFILES, flatten, shard_number, unforked, without_forks
from ..sources.shared import removed, stored


def extracted(files: DataFrame, unit_types: list[str] | None = None) -> dict[str, DataFrame]:
    """Records of the units that pass their gates, by class. `files` should be a stored table: it is read for labels, facts and contents."""
    own = without_forks(files)
    units = detect_units(own)
    # Seven gates read these two, so each is worked out once.
    members = stored(candidates(own, labelled(own, units), units), "members")
    facts = stored(file_facts(own, members), "facts")
    return {t: unit_records(own, members, GATES[t](members, facts)) for t in unit_types or GATES}


def extract_new(spark: SparkSession, source: str, sink: str, checkpoint: str, files_per_batch: int = 64, unit_types: list[str] | None = None) -> None:
    """Takes what is new at source in batches of whole corpus files, and adds JSON lines of units under sink by class and batch."""
    stream = spark.readStream.schema(PROFILES["content"]).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream = stream.select("*", shard_number(F.col("_metadata.file_name")).alias("shard"))  # as a batch read has it

    def write(batch: DataFrame, number: int) -> None:
        files = stored(flatten(unforked(batch)), "batch")  # a lost executor costs no second parse
        for unit_type, records in extracted(files, unit_types).items():
            records.write.mode("overwrite").option("compression", "gzip").json(f"{sink}/unit_type={unit_type}/batch={number}")
        removed(files)

    run_available(stream, write, checkpoint)


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
