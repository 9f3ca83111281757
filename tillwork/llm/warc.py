"""WARC archives: written with an index, read back through it by coalesced byte ranges.

Every record is a gzip member of its own. The writer gives an index row per record (file,
offset, length, URL, digest); readers choose records from the index, sort them by file and
offset, join near neighbours into one byte range and read each range once.

Defined results. Null html is an empty payload; equal payloads are grouped by SHA-1. The
largest page_id of a group is its response, a null page_id counts as the smallest; rows that
repeat that page_id are responses as well. Payloads below ``min_revisit_bytes`` are always
responses. A null URL has no header line, line breaks in one are percent-encoded. Other
columns of the input are ignored. An empty table gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm.common import smaller_batches, staged, table, utf8
from tillwork.session import scratch_folder

DATE = "1970-01-01T00:00:00Z"  # the tables hold no fetch time
ROLL_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
BLOCK_BYTES = 64 << 20
INDEX = (
    "page_id long, record_type string, refers_to long, url string, digest string,"
    " payload_bytes long, file string, offset long, length long"
)
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, url string, payload binary, file string, offset long"
)


def with_record_types(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, record_type, refers_to)`` for each page.

    The groups are reduced to their largest id before the shuffle, and only groups of several
    pages reach the join, whose hot digests the adaptive skew join splits.
    """
    payload = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), utf8("html").alias("payload"))
    keyed = payload.withColumn("sha1", F.unhex(F.sha1("payload")))
    largest = (
        keyed.where(F.length("payload") >= min_revisit_bytes)
        .groupBy("sha1").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return keyed.join(largest, "sha1", "left").select(
        "page_id", "url", "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def record_bytes(page_id, url, payload: bytes, record_type: str, refers_to, digest: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the headers and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if record_type == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
        head.append(f"WARC-Refers-To-Page-ID: {refers_to}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers (lower-case names), HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    warc = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    names = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}
    return {"warc": warc, "http": names, "payload": payload}


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes ``with_record_types`` rows below ``folder``, gives the index.

    A task attempt writes files of its own name and only its index rows name them, so a
    retried or speculative attempt leaves an unused file at worst. Files roll over at
    ROLL_BYTES. The index is written once, beside the archives.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        where.create_dir(root, recursive=True)
        context = TaskContext.get()
        stem = f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, name, at, files = None, "", 0, 0
        try:
            for batch in smaller_batches(batches, 500):
                rows = []
                for page_id, url, payload, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= ROLL_BYTES:
                        if out is not None:
                            out.close()
                        name, at, files = f"{stem}-{files:04d}.warc.gz", 0, files + 1
                        out = where.open_output_stream(f"{root}/{name}", compression=None)
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    member = gzip.compress(record_bytes(page_id, url, payload, kind, refers_to, digest), 4, mtime=0)
                    out.write(member)
                    rows.append((page_id, kind, refers_to, url, digest, len(payload), name, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), INDEX_TYPES)], INDEX_NAMES
                )
        finally:
            if out is not None:
                out.close()

    return staged(records.mapInArrow(write, INDEX), "warc-index")


INDEX_NAMES = [x.split()[0] for x in INDEX.split(",")]
INDEX_TYPES = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in INDEX.split(",")]
RECORD_TYPES = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in RECORD.split(",")]


def coalesced(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list]]:
    """Joins sorted ``(file, offset, length)`` to ``(file, start, end, members)`` ranges.

    Neighbours at most GAP_BYTES apart share a range up to RANGE_BYTES; a repeated record
    is listed as often as it was asked for.
    """
    file, start, end, members = None, 0, 0, []
    for name, offset, length in rows:
        if name != file or offset - end > GAP_BYTES or max(end, offset + length) - start > RANGE_BYTES:
            if members:
                yield file, start, end, members
            file, start, end, members = name, offset, offset, []
        members.append((offset, length))
        end = max(end, offset + length)
    if members:
        yield file, start, end, members


def read_archives(index: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """The records that ``index`` (or any selection of it) names.

    The selection is dealt out by file and block of BLOCK_BYTES and sorted inside a task, so
    a large file is read by many tasks. Payloads are held against their digest; a revisit's
    payload length and digest are those of the full payload, its payload is null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        wanted = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        handle, opened, rows, size = None, None, [], 0
        for file, start, end, members in coalesced(wanted):
            if file != opened:
                if handle is not None:
                    handle.close()
                handle, opened = where.open_input_file(f"{root}/{file}"), file
            data = handle.read_at(end - start, start)
            for offset, length in members:
                rows.append(_record_row(data[offset - start : offset - start + length], file, offset, keep_payload))
                size += len(rows[-1][6] or b"") + 200
                if size > RANGE_BYTES:
                    yield _record_batch(rows)
                    rows, size = [], 0
        if handle is not None:
            handle.close()
        if rows:
            yield _record_batch(rows)

    block = F.floor(F.col("offset") / BLOCK_BYTES)
    spark = index.sparkSession
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BLOCK_BYTES + 1)
    return (  # the number of tasks follows the archives' bytes, not the small index
        index.select("file", "offset", "length")
        .repartition(tasks, F.col("file"), block).sortWithinPartitions("file", "offset")
        .mapInArrow(read, RECORD)
    )


def _record_row(member: bytes, file: str, offset: int, keep_payload: bool) -> tuple:
    record = parse_record(zlib.decompress(member, 31))
    warc, payload = record["warc"], record["payload"]
    size, kind = int(record["http"]["content-length"]), warc["warc-type"]
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record at {file}:{offset}")
    else:
        payload = None
    number = lambda name: int(warc[name]) if name in warc and warc[name] != "None" else None
    url = warc.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return (
        number("warc-page-id"), size, digest, kind, number("warc-refers-to-page-id"), url,
        payload if keep_payload else None, file, offset,
    )


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in RECORD.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RECORD_TYPES)], names)


def archive_round_trip(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Writes all pages, then reads every record back; one row per page."""
    folder = folder or scratch_folder(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = folder if folder.startswith("file:") else f"file://{folder}"
    elif folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file://" + folder.removeprefix("file:")
    index = write_archives(with_record_types(pages, min_revisit_bytes), folder)
    return read_archives(index, folder, keep_payload=False)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# Base32 of the SHA-1: eight groups of five hex digits, each four letters of five bits.
ORACLE_SQL = """
WITH keyed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS largest FROM keyed
)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)
    for i in range(32)], '')
    AS payload_digest,
  CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < largest THEN largest END AS refers_to
FROM grouped
"""
