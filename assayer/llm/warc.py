"""Web archives (WARC 1.1): one gzip member per record, written and read.

Writing: the smallest ``page_id`` among equal payloads keeps the payload as a
``response``; the others become ``revisit`` records that refer to it and hold
the HTTP head only. Each task writes its pages one after another.

Reading: a sequential reader takes an archive in small chunks, inflates one
member after another, frames each record by its content length and verifies
the digests of the block and, where it is there, of the payload.

Defined results: a null html is an empty payload; payloads smaller than
``least`` bytes are always responses; rows that share the smallest ``page_id``
of a payload are all responses; rows without ``page_id`` are responses and
nothing refers to them; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import (
    file_system,
    one_task_each,
    reach_workers,
    save_file,
    written,
)

#: An archive that is as large as this is complete.
ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 18
#: The version line and the profile of the WARC 1.1 standard.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The archives are a function of the table, so that a repeated task writes the
#: same bytes: record ids come from page ids, and the date is a parameter.
NAMESPACE = uuid.UUID("6f6c2a5e-5d0c-4f0c-9d3c-3a2f5c1b7e10")
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, str(page_id))}>"


def record(
    page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: str = DATE
) -> bytes:
    """One record as a gzip member: a revisit if ``refers_to`` is given."""
    revisit = refers_to is not None
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url)),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("Page-ID", "" if page_id is None else str(page_id)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", IDENTICAL),
            ("WARC-Refers-To", record_id(refers_to)),
            ("Refers-To-Page-ID", str(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    body = b"".join((VERSION, b"\r\n", lines, b"\r\n", block, b"\r\n\r\n"))
    return packer.compress(body) + packer.flush()


def _one_line(url: str | None) -> str:
    return "".join(" " if c in "\r\n" else c for c in url or "")


@dataclass(frozen=True)
class Record:
    fields: dict[str, str]
    block: bytes

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        head, _, payload = self.block.partition(b"\r\n\r\n")
        return _fields(head.split(b"\r\n")[1:]), payload


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _members(stream) -> Iterator[bytes]:
    """The content of each gzip member, read in chunks."""
    data = stream.read(CHUNK)
    while data:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if not data:
                raise ValueError("the archive ends within a record")
            parts.append(member.decompress(data))
            data = member.unused_data if member.eof else stream.read(CHUNK)
        yield b"".join(parts)
        data = data or stream.read(CHUNK)


def read_records(stream) -> Iterator[Record]:
    """The records of an archive in order; a damaged one raises ValueError."""
    for content in _members(stream):
        head, blank, rest = content.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        if not blank or lines[0] != VERSION:
            raise ValueError("not a WARC record")
        fields = _fields(lines[1:])
        size = int(fields["content-length"])
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            raise ValueError("the record's length is not its content length")
        found = Record(fields, rest[:size])
        if fields["warc-block-digest"] != f"sha1:{base32_sha1(found.block)}":
            raise ValueError("the block's digest differs")
        if fields["warc-type"] == "response":
            payload = found.http[1]
            if fields["warc-payload-digest"] != f"sha1:{base32_sha1(payload)}":
                raise ValueError("the payload's digest differs")
        yield found


# -- tables ----------------------------------------------------------------------


def with_references(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``html`` and ``refers_to`` (null for a response).

    The smallest ids are found by an aggregation that combines within tasks, so
    that a payload of many pages is no hot group. Joining them back ships each
    payload once; the other side has one short row per payload.
    """
    reach_workers(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html")).withColumn(
        "digest", F.sha1(F.col("html").cast("binary"))
    )
    size = F.octet_length("html")
    firsts = (
        keyed.where((size >= least) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    found = keyed.join(firsts.hint("shuffle_hash"), "digest", "left")
    later = (F.col("page_id") != F.col("first_id")) & (size >= least)
    return found.select(
        "page_id", "url", "html", F.when(later, F.col("first_id")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, folder: str, least: int = 0, most: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write all pages; one row per archive: ``file``, ``records``, ``bytes``.

    A task begins a new archive when one has reached ``most`` bytes.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in batch.to_pylist())
        head, number = next(rows, None), 0
        while head is not None:
            count, size = 0, 0

            def members() -> Iterator[bytes]:
                nonlocal head, count, size
                while head is not None and size < most:
                    made = record(
                        head["page_id"], head["url"], head["html"].encode(), head["refers_to"]
                    )
                    count, size, head = count + 1, size + len(made), next(rows, None)
                    yield made

            name = f"pages-{part:06d}-{number:04d}.warc.gz"
            number += 1
            save_file(folder, name, members())
            yield pa.record_batch(
                {
                    "file": pa.array([name]),
                    "records": pa.array([count], pa.int64()),
                    "bytes": pa.array([size], pa.int64()),
                }
            )

    ready = with_references(pages, least)
    archives = ready.mapInArrow(write, "file string, records long, bytes long")
    return written(pages.sparkSession, archives, "archives")


READ_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, warc_record_id string, payload binary"
)
_ROWS_AT_ONCE = 256


def read_archives(spark: SparkSession, folder: str, archives: DataFrame) -> DataFrame:
    """All records of the archives; a revisit's ``payload`` is null.

    One task reads one archive. The driver holds the archives' names only.
    """
    names = sorted(r["file"] for r in archives.select("file").collect())

    def rows(name: str) -> Iterator[dict]:
        system, path = file_system(folder)
        with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
            for found in read_records(stream):
                fields = found.fields
                head, payload = found.http
                response = fields["warc-type"] == "response"
                refers_to = fields.get("refers-to-page-id")
                yield {
                    "page_id": int(fields["page-id"]) if fields["page-id"] else None,
                    "url": fields["warc-target-uri"],
                    "payload_bytes": int(head["content-length"]),
                    "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
                    "record_type": fields["warc-type"],
                    "refers_to": int(refers_to) if refers_to else None,
                    "warc_record_id": fields["warc-record-id"],
                    "payload": payload if response else None,
                }

    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("warc_record_id", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch["shard"].to_pylist():
                if shard >= len(names):
                    continue
                some = []
                for row in rows(names[shard]):
                    some.append(row)
                    if len(some) == _ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(some, schema)
                        some = []
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema)

    return one_task_each(spark, len(names)).mapInArrow(read, READ_SCHEMA)
