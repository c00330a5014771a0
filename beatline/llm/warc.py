"""WARC archives: written by Spark's own file writer, read sequentially.

Every record is a gzip member of its own. The reader takes an archive in
blocks, decompresses them step by step, ends each record at its member's end,
frames the block by Content-Length, and checks block and payload digests.

Writing: Spark's text writer puts out a row's bytes as they are and a line
separator after them. The last byte of a gzip member is the highest byte of
its uncompressed length, so 0 for a record under 16 MB. A row is therefore a
run of members less that last byte, and the separator is a zero byte. A run
that ends with a larger record is closed by a small ``metadata`` record. So
archives are whole, standard files, written to any file system that Spark
knows, with its commit protocol (a lost task's files never count).
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.llm.common import pick, slices
from beatline.session import scratch_path

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK = 64 << 10
CHUNK_BYTES = 1 << 20
CHUNKS_PER_FILE = 64
_SMALL = 1 << 24
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None = None, payload_digest: str | None = None) -> str:
    """A new record's id; with a page and its digest that of the response which
    revisits name."""
    own = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{payload_digest}")
    return f"<urn:uuid:{own}>"


def member(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as one gzip member."""
    head = [("WARC-Type", kind), ("WARC-Date", DATE), *headers,
            ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, named: bool) -> bytes:
    """The record of a page: a response with its payload, or a revisit that
    keeps the payload's digest and length. ``named``: the response is the only one
    of its page and payload, so revisits name it by its record id."""
    own = digest(payload)
    first = record_id(page_id if refers_to is None else refers_to, own) if named else record_id()
    about = [("WARC-Record-ID", first if refers_to is None else record_id()),
             ("WARC-Target-URI", (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")),
             ("WARC-Payload-Digest", f"sha1:{own}"), ("Page-ID", "" if page_id is None else str(page_id))]
    if refers_to is None:
        return member("response", [*about, ("Content-Type", "application/http; msgtype=response")], _HTTP + payload)
    return member("revisit", [
        *about, ("WARC-Profile", PROFILE), *[("WARC-Refers-To", first)] * named,
        ("Refers-To-Page-ID", str(refers_to)), ("Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response")], _HTTP)


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def read_records(stream: io.BufferedIOBase, block_bytes: int = BLOCK) -> Iterator[Record]:
    """The records of one archive, in order. Holds one record and one block of
    the file. Raises ValueError at a damaged or cut-off record."""
    unpack, parts, data = None, [], b""
    while True:
        data = data or stream.read(block_bytes)
        if not data:
            break
        unpack = unpack or zlib.decompressobj(31)
        try:
            parts.append(unpack.decompress(data))
        except zlib.error as e:
            raise ValueError(f"not a gzip member: {e}") from e
        data = unpack.unused_data
        if unpack.eof:
            yield _framed(b"".join(parts))
            unpack, parts = None, []
    if unpack is not None:
        raise ValueError("the archive ends inside a record")


def _framed(raw: bytes) -> Record:
    head, gap, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or not first.startswith(b"WARC/1."):
        raise ValueError("no WARC header")
    headers = {}
    for line in lines:
        name, _, value = line.decode().partition(":")
        headers[name.strip().lower()] = value.strip()
    size = int(headers.get("content-length", "-1"))
    block, end = rest[:size], rest[size:]
    if size < 0 or len(block) != size or end != b"\r\n\r\n":
        raise ValueError("Content-Length does not fit the record")
    _check(headers.get("warc-block-digest"), block, "block")
    return Record(headers, block)


def _check(given: str | None, data: bytes, what: str) -> None:
    """Digests are optional; one by SHA-1, in base32 or hex, must fit, others are not judged."""
    kind, _, value = (given or "").partition(":")
    if kind.lower() in ("sha1", "sha-1") and value.upper() not in (digest(data), hashlib.sha1(data).hexdigest().upper()):
        raise ValueError(f"the {what} digest does not fit the record")


def _whole(value: str | None) -> int | None:
    return int(value) if value else None


def _bare(given: str | None) -> str | None:
    return given.partition(":")[2] or given if given else None


def page_row(record: Record) -> tuple | None:
    """A page record's values, in the order of ``ROW``, its payload digest checked;
    None for other records. Without a ``Page-ID`` the page, and without the sizes and
    names that only this module's revisits carry, these are null. A response's bytes
    and digest are those of its payload: what follows the HTTP header, or the whole
    block where it is not an HTTP message."""
    h = record.headers
    if h.get("warc-type") not in ("response", "revisit"):
        return None
    about = h.get("warc-record-id"), h.get("warc-target-uri")
    if h["warc-type"] == "revisit":
        return (_whole(h.get("page-id")), _whole(h.get("payload-length")), _bare(h.get("warc-payload-digest")), "revisit",
                _whole(h.get("refers-to-page-id")), *about, h.get("warc-refers-to"))
    http = h.get("content-type", "application/http").lower().startswith("application/http")
    payload = record.block.partition(b"\r\n\r\n")[2] if http else record.block
    _check(h.get("warc-payload-digest"), payload, "payload")
    return _whole(h.get("page-id")), len(payload), digest(payload), "response", None, *about, None


def _chunks(rows) -> Iterator[bytes]:
    """Runs of members whose last byte is a zero byte."""
    close = lambda: member("metadata", [("WARC-Record-ID", record_id()), ("Content-Type", "text/plain")], b"")
    parts, size = [], 0
    for row in rows:
        parts.append(page_record(*row))
        size += len(parts[-1])
        if size >= CHUNK_BYTES:
            yield b"".join(parts if parts[-1][-1] == 0 else [*parts, close()])
            parts, size = [], 0
    if parts:
        yield b"".join(parts if parts[-1][-1] == 0 else [*parts, close()])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0) -> None:
    """Write a record per row to WARC archives in the folder ``path``.

    Of rows with equal payloads of at least ``min_bytes`` bytes, that with the
    largest id is a response and the others are revisits of it. Rows that tie
    for the largest id are all responses; a null id counts as the smallest
    (only null ids: all responses). A null html is an empty payload, a null url
    ``about:blank``. An empty table gives a folder without archives.

    Only (digest, id) pairs are grouped, with partial aggregation; payloads
    meet their group's id by a join, in which Spark splits a hot payload.
    """
    pages = pick(pages, page_id=(id_col, "long"), url=(url_col, "string"), html=(html_col, "string")) \
        .withColumn("html", F.coalesce("html", F.lit(""))) \
        .withColumn("sha1", F.sha1("html")).withColumn("size", F.octet_length("html"))
    groups = (pages.filter(F.col("size") >= min_bytes).groupBy("sha1", "size", "page_id").agg(F.count("*").alias("n"))
              .groupBy("sha1", "size").agg(F.max("page_id").alias("largest"), F.sum("n").alias("n"),
                                           F.max_by("n", "page_id").alias("ties"))
              .filter("n > 1 and largest is not null").drop("n"))
    marked = pages.join(groups, ["sha1", "size"], "left").select(
        "page_id", "url", "html",
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("largest")), F.col("largest")).alias("refers_to"),
        F.coalesce(F.col("ties") == 1, F.lit(False)).alias("named"))

    def pack(batches):
        def rows():
            for batch in slices(batches, "html"):
                for i, url, html, to, named in zip(*(batch.column(c).to_pylist() for c in (
                        "page_id", "url", "html", "refers_to", "named"))):
                    yield i, url, html.encode(), to, named

        for chunk in _chunks(rows()):
            yield pa.RecordBatch.from_arrays([pa.array([chunk[:-1]], pa.binary())], names=["members"])

    (marked.mapInArrow(pack, "members binary").select(F.col("members").cast("string"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", CHUNKS_PER_FILE).text(path))


#: The columns of a page record.
ROW = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
       "refers_to": pa.int64(), "record_id": pa.string(), "target_uri": pa.string(), "refers_to_record": pa.string()}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per page record (response or revisit) of the archives in ``path``:
    ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, ``record_id``, ``target_uri``, ``refers_to_record``. Archives of
    other writers have no page ids: these, and ``refers_to``, are null."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                found = [x for x in map(page_row, read_records(pa.BufferReader(content.as_buffer()))) if x]
                columns = zip(*found) if found else [()] * len(ROW)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ROW.values())], names=list(ROW))

    kinds = {pa.int64(): "long", pa.string(): "string"}
    return files.mapInArrow(read, ", ".join(f"{c} {kinds[t]}" for c, t in ROW.items()))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """``write_archives`` to a new folder under spark.checkpoint.dir, then
    ``read_archives``."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **options)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
