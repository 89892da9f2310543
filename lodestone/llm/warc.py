"""WARC archives with a Zstandard dictionary: made from an archive's own records, put ahead of them in a skippable frame.

One record a row. Of rows with equal payloads of MIN_REVISIT bytes or more, that with the largest
key is the response and the others are revisits that name it and carry no payload; shorter
payloads are always responses. Every record is a Zstandard frame of its own, so an archive can be
read from any frame's start; a reader finds frames by their block headers, without decompressing.

Archives are rows of a table in the shared folder (part, seq, records, file), each about
ARCHIVE_BYTES of payload. Digests and lengths are worked out on the JVM and joined by key, so
payloads are shuffled once and evenly, however many are equal. A null payload is empty; a null key
is below every other; rows that share key and payload are all what one such row would be.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written

MIN_REVISIT = 1000
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 6
#: Magic number of the skippable frame that holds a dictionary in Zstandard WARC files.
SKIPPABLE = 0x184D2A5D
DATE = "2000-01-01T00:00:00Z"


def record_id(key: int | None) -> str:
    return f"<urn:lodestone:page:{'null' if key is None else key}>"


def key_of(urn: str) -> int | None:
    name = urn.strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def record(key: int | None, url: str, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url.replace(chr(13), '').replace(chr(10), '')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_from(records: list[bytes]) -> bytes:
    """A dictionary trained on all records; what they begin with, where there are too few to train on."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, records)) // 8)), records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(s[:2048] for s in records)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n"


def archive(records: list[bytes]) -> bytes:
    raw = dictionary_from(records)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(compressor.compress, records)])


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at a place ends, from its header and its blocks' headers."""
    checksum = data[at + 4] >> 2 & 1
    at += zstandard.frame_header_size(data[at : at + 18])
    while True:
        head = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * checksum


def records_of(file: bytes) -> Iterator[dict]:
    """Every record of an archive: its headers, payload length, payload (None for revisits)."""
    data = memoryview(file)
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary in front")
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8 : 8 + size])))
    at = 8 + size
    while at < len(data):
        end = frame_end(data, at)
        head, _, block = decompressor.decompress(data[at:end]).partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        http, _, payload = block[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
        length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield headers | {"length": length, "payload": payload if headers["WARC-Type"] == "response" else None}
        at = end


def write_archives(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url", min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), body.alias("payload"))
    facts = rows.select("k", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"))
    keepers = facts.where(F.col("n") >= min_revisit).groupBy("digest").agg(F.max("k").alias("keeper"), F.count(F.lit(1)).alias("equal"))
    named = F.coalesce("k", F.lit(-(1 << 63)))
    kinds = facts.join(keepers, "digest").where((F.col("equal") > 1) & ~F.col("k").eqNullSafe(F.col("keeper"))).select(named.alias("name"), "digest", "keeper").distinct()
    typed = rows.withColumn("name", named).withColumn("digest", F.sha1("payload")).join(kinds, ["name", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "records": pa.array([len(held)], pa.int64()), "file": pa.array([archive(held)], pa.binary())})

        for batch in batches:
            for k, u, body, keeper in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                if size >= archive_bytes:
                    yield full()
                    seq, held, size = seq + 1, [], 0
                held.append(record(k, u, body.as_py(), "response" if keeper is None else "revisit", keeper))
                size += len(held[-1])
        if held:
            yield full()

    return written(typed.select("k", "url", "payload", "keeper").mapInArrow(run, "part int, seq int, records bigint, file binary"), "warc")


def read_archives(files: DataFrame, key: str = "page_id") -> DataFrame:
    """key, payload_bytes, payload_digest (hex), record_type and refers_to of every record; a response's digest is checked against its payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                out = [[], [], [], [], []]
                for r in records_of(file.as_py()):
                    digest = base64.b32decode(r["WARC-Payload-Digest"].removeprefix("sha1:"))
                    if r["payload"] is not None and hashlib.sha1(r["payload"]).digest() != digest:
                        raise ValueError(f"digest of {r['WARC-Record-ID']} does not hold")
                    values = (key_of(r["WARC-Record-ID"]), r["length"], digest.hex(), r["WARC-Type"], key_of(r["WARC-Refers-To"]) if "WARC-Refers-To" in r else None)
                    for column, v in zip(out, values, strict=True):
                        column.append(v)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[key, "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return files.select("file").mapInArrow(run, f"{key} bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
