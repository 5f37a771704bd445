"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Every record is a gzip member of its own. A reading task is given a byte range. It
looks for the gzip magic in it, takes a place as a member only if the bytes inflate to
a WARC header, and reads every record that starts in its range, also where it ends
beyond. So ranges of any size give each record exactly once.

The writer leaves a manifest of the files that succeeded; what a lost or repeated task
wrote besides is in no manifest and so is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import scratch, stage

MAGIC = b"\x1f\x8b\x08"
LEAST_REVISIT = 100  # bytes of payload from which an equal one is a revisit
SPLIT = 16 << 20  # bytes of archive for a reading task
BLOCK = 1 << 20
HEADER = 1 << 16  # inflated bytes within which the header of a record must end
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

RECORDS = (
    "path string, offset bigint, type string, record_id string, target_uri string, refers_to string, "
    "declared_digest string, http_length bigint, payload binary"
)


def _files(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _named(key) -> str:
    return f"<urn:row:{'null' if key is None or pd.isna(key) else int(key)}>"


def _record(key, url, first, digest, payload: bytes | None, length: int) -> bytes:
    """One record: an HTTP response, whose payload a revisit leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {_named(key)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url:
        fields.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if payload is None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_named(first)}"]
    fields.append(f"Content-Length: {len(block)}")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(folder)
        path, size, out = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            columns = [batch.column(n) for n in ("key", "url", "first", "digest", "payload", "length")]
            for i in range(len(batch)):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(path, compression=None)
                packed = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packed.compress(_record(*(c[i].as_py() for c in columns))) + packed.flush()
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
            yield pa.record_batch({"path": [path], "bytes": pa.array([size], pa.int64())})

    return work


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Write a record per row below ``folder``, which all executors must share; return
    the manifest (path, bytes).

    Of the rows with equal payloads of at least 100 bytes, that with the smallest key is
    a response and the others are revisits of it. Rows that repeat this key as well are
    responses; null keys are larger than all others, and responses if there are no
    others. Null payloads are empty, null and empty addresses are left out, and other
    columns are not archived. An empty table gives an empty manifest.
    """
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("length", F.octet_length("payload"))
    firsts = (
        rows.filter(F.col("length") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("rows"))
        .filter((F.col("rows") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    found = rows.join(firsts, "digest", "left").select(
        "key",
        "url",
        F.when(revisit, F.col("first")).alias("first"),
        "digest",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.col("length").cast("long").alias("length"),
    )
    return stage(found.mapInArrow(_writer(folder), "path string, bytes bigint"), "warc-manifest")


def _member(stream, start: int, lead: bytes):
    """The inflated member that begins with ``lead`` at ``start``, and where it ends."""
    unpack, out, used = zlib.decompressobj(31), [], start
    block = lead
    while block:
        out.append(unpack.decompress(block))
        used += len(block)
        if unpack.eof:
            return b"".join(out), used - len(unpack.unused_data), unpack.unused_data
        stream.seek(used)
        block = stream.read(BLOCK)
    raise OSError(f"archive ends inside the record at byte {start}")


def _starts_record(lead: bytes) -> bool:
    """Whether bytes that begin with the magic inflate to the header of a record."""
    try:
        head = zlib.decompressobj(31).decompress(lead, HEADER)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.")


def _records(stream, size: int, start: int, end: int):
    """(offset, bytes) of the records that start in [start, end)."""
    at, held = start, b""
    while at < end:
        if not held:
            stream.seek(at)
            held = stream.read(BLOCK)
        found = held.find(MAGIC)
        if found < 0:  # the magic may lie across two blocks
            at += max(len(held) - len(MAGIC) + 1, 1)
            held = b""
            continue
        at += found
        held = held[found:]
        if at >= end:
            return
        if len(held) < min(HEADER, size - at):
            stream.seek(at)
            held = stream.read(BLOCK)
        if not _starts_record(held[:HEADER]):
            at, held = at + 1, held[1:]
            continue
        record, after, rest = _member(stream, at, held)
        yield at, record
        at, held = after, rest


def _parsed(record: bytes) -> dict:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = block[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = None
    for line in http.decode("latin-1").split("\r\n"):
        if line.lower().startswith("content-length:"):
            length = int(line.split(":", 1)[1])
    kind = fields.get("warc-type")
    return {
        "type": kind,
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "declared_digest": fields.get("warc-payload-digest"),
        "http_length": length,
        "payload": payload if kind == "response" else None,
    }


def _reader(root: str):
    schema = pa.schema(
        [(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in RECORDS.split(", "))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _files(root)
        for batch in batches:
            for split in batch.to_pylist():
                rows, held = [], 0
                with files.open_input_file(split["path"]) as stream:
                    for offset, record in _records(stream, split["bytes"], split["start"], split["end"]):
                        rows.append({"path": split["path"], "offset": offset, **_parsed(record)})
                        held += len(record)
                        if held > 8 * BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return work


def read_warc(manifest: DataFrame, folder: str, split: int = SPLIT) -> DataFrame:
    """Every record of the files of ``manifest``, read in ranges of ``split`` bytes."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start")
    ranges = manifest.filter(F.col("bytes") > 0).select("path", "bytes", starts)
    ranges = ranges.withColumn("end", F.least(F.col("start") + split, F.col("bytes")))
    tasks = max(1, manifest.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1)
    return ranges.repartition(int(tasks)).mapInArrow(_reader(folder), RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives and read them back: one row per page."""
    folder = scratch(pages.sparkSession, "warc")
    records = read_warc(write_warc(pages, folder), folder)
    full = F.col("type") == "response"

    def key(column: str):
        return F.regexp_extract(column, r"<urn:row:(-?\d+)>", 1).try_cast("long")

    return records.select(
        key("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256))
        .otherwise(F.replace("declared_digest", F.lit("sha256:"), F.lit("")))
        .alias("payload_digest"),
        F.col("type").alias("record_type"),
        key("refers_to").alias("refers_to"),
    )
