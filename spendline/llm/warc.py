"""WARC archives: written with three records a capture, read back, and assembled by their concurrent-to identifiers."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
RECORDS_A_FILE = 3000
_END = "\r\n\r\n"
PARSED = ("record_id string, kind string, concurrent_to string, refers_to string, uri string, digest string, "
          "block_bytes long, block_digest string, block binary")


def _record(kind: str, record_id: str, uri: str, block: bytes, extra: list[tuple[str, str]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", "2000-01-01T00:00:00Z"), *extra]
    head += [("WARC-Target-URI", uri)] if uri else []
    head += [("Content-Length", str(len(block)))]
    return f"{VERSION}\r\n{''.join(f'{name}: {value}\r\n' for name, value in head)}\r\n".encode() + block


def record_id(kind: str, key: object, digest: str) -> str:
    return f"<urn:capture:{kind}:{'' if key is None else key}:{digest}>"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record; gzip members are opened one after another. A cut-off record is an error."""
    if data[:2] == b"\x1f\x8b":
        parts = []
        while data:
            stream = zlib.decompressobj(31)
            parts.append(stream.decompress(data))
            if not stream.eof:
                raise ValueError("cut-off gzip member")
            data = stream.unused_data
        data = b"".join(parts)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record at byte {at}")
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError(f"cut-off record at byte {at}")
        yield headers, block
        at = end + 4 + size + len(_END)


def _one_line(uri: str | None) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", uri or "")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", uri_col: str = "url") -> None:
    """Write request, response or revisit, and metadata records of every row as gzipped WARC files in the folder `path`.

    Of rows with equal payloads the one with the largest id is the response; the others become revisit records without a payload
    that refer to it. Null payload: empty. A null id counts as smallest. Rows that share both id and payload are the same capture
    and have the same type. A file holds at most `RECORDS_A_FILE` records, so that a reader never meets more at once.

    The record's end (two line ends) is the writer's line separator, so that any file system Spark writes to will do.
    """
    chosen = pages.select(F.col(id_col).alias("page"), F.col(uri_col).alias("uri"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    captures = chosen.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    first = captures.groupBy("digest").agg(F.max("page").alias("original"))
    joined = captures.join(first, "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                page, uri, payload = row["page"], _one_line(row["uri"]), row["payload"].encode()
                digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                main, named = record_id("response", page, digest), [("WARC-Payload-Digest", f"sha1:{digest}")]
                if page == row["original"]:
                    records.append(_record("response", main, uri, payload, named))
                else:
                    records.append(_record("revisit", main, uri, b"", [
                        *named, ("WARC-Refers-To", record_id("response", row["original"], digest)),
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]))
                beside = [("WARC-Concurrent-To", main)]
                records.append(_record("request", record_id("request", page, digest), uri, b"GET", beside))
                notes = f"page: {'' if page is None else page}\r\npayload-bytes: {len(payload)}".encode()
                records.append(_record("metadata", record_id("metadata", page, digest), uri, notes, beside))
                held += len(payload)
                if held > 4_000_000 or len(records) >= 3000:
                    yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], names=["value"])
                    records, held = [], 0
        if records:
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], names=["value"])

    (joined.mapInArrow(run, "value string").write.option("lineSep", _END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_A_FILE).text(path))


def read_archive(spark: SparkSession, path: str, with_blocks: bool = True) -> DataFrame:
    """One row per record of the plain or gzipped WARC files in `path` (a folder or a pattern).

    Files are read one at a time and whole; `block` is null without `with_blocks`, while `block_bytes` and `block_digest` (SHA-1 in
    base32 of what was read) stay. Metadata blocks are always there.
    """
    schema = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
                        ("uri", pa.string()), ("digest", pa.string()), ("block_bytes", pa.int64()), ("block_digest", pa.string()), ("block", pa.binary())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for value in batch.column(0):
                for headers, block in parse_records(value.as_py() or b""):
                    digest, kind = headers.get("warc-payload-digest"), headers["warc-type"]
                    keep = with_blocks or kind == "metadata"
                    rows.append((headers["warc-record-id"], kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
                                 headers.get("warc-target-uri"), digest and digest.partition(":")[2], len(block),
                                 base64.b32encode(hashlib.sha1(block).digest()).decode(), block if keep else None))
                    held += len(block) if keep else 0
                    if held > 4_000_000 or len(rows) >= 3000:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, PARSED)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: `record_id`, `kind`, `uri`, `digest`, `refers_to`, `block`, `request` and `metadata`.

    Requests and metadata name the record they belong to by WARC-Concurrent-To. A capture without one of them has null there;
    a request or metadata record without its capture is kept, with the identifier it names and no kind.
    """
    main = records.where(F.col("kind").isin("response", "revisit")).select("record_id", "kind", "uri", "digest", "refers_to", "block_bytes", "block_digest", "block")
    part = F.struct("record_id", F.col("block").cast("string").alias("text"))
    beside = (records.where(F.col("kind").isin("request", "metadata"))
              .select(F.col("concurrent_to").alias("record_id"), F.when(F.col("kind") == "request", part).alias("request"),
                      F.when(F.col("kind") == "metadata", part).alias("metadata")))
    beside = beside.groupBy("record_id").agg(F.first("request", True).alias("request"), F.first("metadata", True).alias("metadata"))
    return main.join(beside, "record_id", "full_outer")
