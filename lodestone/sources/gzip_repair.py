"""Damaged gzip files of JSON lines: what each member still yields, as rows.

Members are walked one after another; a damaged one gives its bytes up to the fault, and the walk
goes on at the next gzip magic. Lines split over two members are put together. One Python worker
reads one file; the rest is relational: bad JSON is counted, repeats keep the first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAGIC = b"\x1f\x8b\x08"
KEY = ["repo_path", "unit_prefix", "unit_type", "commit_id"]
CHUNK = 1 << 16


def members(data: bytes, chunk: int = CHUNK) -> Iterator[tuple[int, bytes, bool]]:
    """(number, bytes, truncated) of each gzip member."""
    at, number = data.find(MAGIC), 0
    while at >= 0:
        inflate, out, fed, broken = zlib.decompressobj(31), [], at, False
        while not inflate.eof and fed < len(data):
            step = 1 if broken else chunk
            try:
                copy = inflate.copy()
                piece = data[fed : fed + step]
                out.append(inflate.decompress(piece))
                fed += len(piece)
            except zlib.error:
                if broken:
                    break
                inflate, broken = copy, True  # once more, byte by byte, to keep all before the fault
        if inflate.eof:
            end = fed - len(inflate.unused_data)
            yield number, b"".join(out), False
        else:
            end = at + 1
            yield number, b"".join(out), True
        number += 1
        at = data.find(MAGIC, end)


def lines(data: bytes) -> Iterator[tuple[int, int, bool, str]]:
    """(member, number, truncated member, line) of a file; a part of a line left by a member goes before the next one's first."""
    rest, number = b"", 0
    for member, body, truncated in members(data):
        *whole, rest = (rest + body).split(b"\n")
        for line in whole:
            if line.strip():
                yield member, number, truncated, line.decode("utf-8", "replace")
                number += 1
        if truncated:
            if rest.strip():
                yield member, number, truncated, rest.decode("utf-8", "replace")
                number += 1
            rest = b""
    if rest.strip():
        yield member, number, False, rest.decode("utf-8", "replace")


class GzipRecords:
    """Table function: gzip_records(bytes) -> member, seq, truncated, line."""

    def eval(self, data: bytes) -> Iterator[tuple[int, int, bool, str]]:
        yield from lines(bytes(data or b""))


def salvaged(files: DataFrame) -> DataFrame:
    """(name, member, seq, truncated, line) from a table (name, bytes)."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = list(lines(data.as_py() or b""))
                columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
                kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["name", "member", "seq", "truncated", "line"])

    return files.select("name", "bytes").mapInArrow(run, "name string, member int, seq bigint, truncated boolean, line string")


def read_damaged(spark: SparkSession, path: str) -> DataFrame:
    return salvaged(spark.read.format("binaryFile").load(path).select(F.col("path").alias("name"), F.col("content").alias("bytes")))


def records(salvage: DataFrame) -> DataFrame:
    """Lines with the record key and shard, whether they parse, and whether an equal record came before.

    Behind a fault a damaged member yields garbage for a while, so of its lines only records with the whole key count as parsed;
    `truncated` marks them all."""
    j = F.from_json("line", "repo_path string, unit_prefix string, unit_type string, commit_id string, shard int, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    whole = reduce(lambda a, b: a & b, (F.col(f"j.{k}").isNotNull() for k in KEY))
    rows = salvage.withColumn("j", j).select("name", "member", "seq", "truncated", "line", *[F.col(f"j.{k}").alias(k) for k in [*KEY, "shard"]], (F.col("j").isNotNull() & F.col("j._corrupt").isNull() & (~F.col("truncated") | whole)).alias("parsed"))
    order = Window.partitionBy("name", "parsed", *KEY).orderBy("member", "seq")
    return rows.withColumn("first", F.row_number().over(order) == 1)


def repaired(salvage: DataFrame) -> DataFrame:
    """The first of each record, with a mark on those that a damaged member yielded."""
    return records(salvage).where("parsed and first").select("name", "member", "seq", "truncated", "line")


def counters(salvage: DataFrame) -> DataFrame:
    """One row a file: lines recovered, duplicate and unparseable, and distinct shards."""
    r = records(salvage)
    return r.groupBy("name").agg(
        F.count_if(F.col("parsed") & F.col("first")).alias("lines_recovered"),
        F.count_if(F.col("parsed") & ~F.col("first")).alias("lines_duplicate"),
        F.count_if(~F.col("parsed")).alias("lines_unparseable"),
        F.count_distinct("member").alias("members_with_lines"),
        F.count_distinct(F.when(F.col("truncated"), F.col("member"))).alias("members_truncated"),
        F.count_distinct(F.when(F.col("parsed"), F.col("shard"))).alias("shards_seen"),
    )
