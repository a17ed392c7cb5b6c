"""Legacy web archives (ARC, versions 1 and 2) to WARC 1.0.

An ARC file is a version block and records of a header line and a body whose length the
line declares. The version block says which fields a line has. From a line and its body the
converter makes what WARC asks for: a record id (a name-based UUID of what the record is, so
that a task that runs again writes the same), an ISO timestamp, a record type, a content type
and SHA-1 digests. Records whose payload was stored before become revisits.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import datetime
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_folder
from .common import workers_know

#: Fields of a header line by version of the archive, as the public format descriptions give them.
FIELDS = {
    "1": ("url", "ip", "date", "type", "length"),
    "2": ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
ARCHIVE_BYTES, RECORDS_PER_FILE, REVISIT_BYTES = 8_000_000, 2000, 1000
#: A task begins a new WARC file after so many bytes, so one that is read again fits a task.
FILE_BYTES, HEADER_BYTES = 64_000_000, 600
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD = "uri string, date string, type string, record_id string, payload_digest string, payload_sha1 string, payload_bytes long, payload binary"


def arc_header(version: str, name: str, when: str) -> bytes:
    """The version block that begins an archive."""
    body = f"{version} 0 tidegauge\n{' '.join({'url': 'URL', 'ip': 'IP-address', 'date': 'Archive-date', 'type': 'Content-type', 'length': 'Archive-length', 'result': 'Result-code', 'checksum': 'Checksum', 'location': 'Location', 'offset': 'Offset', 'filename': 'Filename'}[f] for f in FIELDS[version])}\n".encode()
    middle = "text/plain" if version == "1" else f"text/plain 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {when} {middle} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: str, url: str, when: str, kind: str, body: bytes, name: str, offset: int) -> bytes:
    middle = kind if version == "1" else f"{kind} 200 - - {offset} {name}"
    return f"{url} 0.0.0.0 {when} {middle} {len(body)}\n".encode() + body + b"\n"


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The header fields and body of every record, by the declared lengths alone.

    A body may hold anything, lines that look like headers too. A file that ends
    within a record, or a line with another number of fields, is an error.
    """
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        parts = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r").split(" ")
        length = int(parts[-1]) if parts[-1].isdigit() else -1
        body = data[end + 1 : end + 1 + length]
        if end < 0 or length < 0 or len(body) != length:
            raise ValueError(f"no whole record at byte {at}")
        if fields is None:
            version = body.split(b" ", 1)[0].decode("ascii", "replace")
            if not parts[0].startswith("filedesc://") or version not in FIELDS:
                raise ValueError("no version block of a known version")
            fields = FIELDS[version]
        elif len(parts) < len(fields):
            raise ValueError(f"{len(parts)} fields instead of {len(fields)} at byte {at}")
        else:  # a URL may have spaces in it; all other fields have none
            extra = len(parts) - len(fields) + 1
            yield dict(zip(fields, [" ".join(parts[:extra]), *parts[extra:]])), body
        at = end + 1 + length


def iso_time(digits: str) -> str:
    """Archive dates have 12 or 14 digits; one that is no time becomes the epoch."""
    try:
        return datetime.strptime(digits.ljust(14, "0")[:14], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def warc_fields(header: dict[str, str], body: bytes) -> dict:
    """What a WARC record has in addition to the payload."""
    digest = hashlib.sha1(body).digest()
    date = iso_time(header["date"])
    name = f"{header['url']} {date} {digest.hex()} {header.get('offset', '')}"
    return {
        "uri": header["url"],
        "date": date,
        "type": header["type"],
        "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "payload_digest": "sha1:" + base64.b32encode(digest).decode(),
        "payload_sha1": digest.hex(),
        "payload_bytes": len(body),
    }


def converted(archives: DataFrame, content: str = "content") -> DataFrame:
    """Records of ARC archives (binary, one archive a row, as ``binaryFile`` reads them) with what WARC needs.

    A null or empty archive has no record; a damaged one is an error that names the byte.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = [warc_fields(header, body) | {"payload": body} for header, body in arc_records(data.as_py() or b"")]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return workers_know(archives).select(content).mapInArrow(run, RECORD)


def archived(pages: DataFrame, uri: str, body: str, version: str = "1") -> DataFrame:
    """Pages as ARC archives of about ``ARCHIVE_BYTES``: a binary column ``content``. For rows that come as a table.

    Null bodies are empty. White space in a uri is written as %20, %09 and so on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        when, name = "20240101000000", "pages.arc"
        head = arc_header(version, name, when)
        out, size = [head], len(head)
        for batch in batches:
            for page, html in zip(batch.column(0), batch.column(1)):
                url = "".join(f"%{ord(c):02X}" if c in " \t\r\n\x0b\x0c" else c for c in page.as_py() or "-")
                record = arc_record(version, url, when, "text/html", (html.as_py() or "").encode(), name, size)
                out.append(record)
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], names=["content"])
                    out, size = [head], len(head)
        if len(out) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], names=["content"])

    return workers_know(pages).select(F.col(uri), F.col(body)).mapInArrow(run, "content binary")


def with_revisits(records: DataFrame, key: str) -> DataFrame:
    """``records`` with record_type, refers_to and refers_id: of equal payloads the largest ``key`` is the response.

    Payloads below ``REVISIT_BYTES`` are all responses. Equal means equal SHA-1 and length;
    a null key is smaller than any, and rows that share the largest key are all responses.
    Payloads are shuffled once; a payload that very many records share is one row on
    the other side, so adaptive execution divides its records.
    """
    top = F.max(F.struct(key, "record_id")).alias("_top")
    shared = records.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_sha1", "payload_bytes").agg(top, F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    joined = records.join(shared, ["payload_sha1", "payload_bytes"], "left")
    again = F.col("_top").isNotNull() & ~F.col(key).eqNullSafe(F.col(f"_top.{key}"))
    kinds = F.when(again, "revisit").otherwise("response").alias("record_type")
    return joined.select(*records.columns, kinds, F.when(again, F.col(f"_top.{key}")).alias("refers_to"), F.when(again, F.col("_top.record_id")).alias("refers_id"))


def warc_text(records: DataFrame, key: str, *more: Column) -> DataFrame:
    """One WARC record a row (``value``): its header and, for responses, its payload, byte for byte."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("-"))
    refers = F.concat(F.lit("WARC-Refers-To: "), "refers_id", F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nX-Refers-To-Key: "), shown("refers_to"), F.lit("\r\n"))
    head = [
        "WARC/1.0\r\nWARC-Type: ", F.col("record_type"),
        "\r\nWARC-Record-ID: ", F.col("record_id"),
        "\r\nWARC-Date: ", F.col("date"),
        "\r\nWARC-Target-URI: ", F.col("uri"),
        "\r\nWARC-Payload-Digest: ", F.col("payload_digest"),
        "\r\nX-Key: ", shown(key),
        "\r\nX-Payload-Length: ", F.col("payload_bytes").cast("string"), "\r\n",
        F.when(revisit, refers).otherwise(F.lit("")),
        "Content-Type: ", F.col("type"),
        "\r\nContent-Length: ", F.octet_length(body).cast("string"), "\r\n\r\n", body,
    ]
    return records.select(F.concat(*[F.lit(x) if isinstance(x, str) else x for x in head]).alias("value"), *more)


def _file(size: int):
    """Column function from the bytes of a record to the number of its task's file that it begins in."""

    @F.arrow_udf("long")
    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        before = 0
        for batch in batches:
            sizes = batch.to_numpy(zero_copy_only=False)
            ends = before + np.cumsum(sizes)
            yield pa.array((ends - sizes) // size)
            before = int(ends[-1]) if len(ends) else before

    return number.asNondeterministic()


def write_warc(records: DataFrame, key: str) -> str:
    """Writes the records as gzipped WARC files to the shared folder and returns its path.

    What ends a record is the writer's line separator, so Spark's own writer and its
    commits do the work. A task fills files of about ``FILE_BYTES`` before compression, one
    record more at most, and of ``RECORDS_PER_FILE`` records; the n-th ones of all tasks are in folder ``file=n``.
    """
    path = fresh_folder(records.sparkSession, "warc")
    stored = F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes")) + HEADER_BYTES
    numbered = workers_know(records).withColumn("_file", _file(FILE_BYTES)(stored.cast("long")))
    texts = warc_text(numbered, key, F.col("_file").alias("file"))
    writer = texts.write.partitionBy("file").option("lineSep", END.decode()).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


def warc_records(file: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record, by its declared length."""
    while line := file.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        length = int(fields["content-length"])
        block = file.read(length)
        if len(block) != length or file.read(len(END)) != END:
            raise ValueError(f"record {fields.get('warc-record-id')} ends too early")
        yield fields, block


READ = "key long, record_type string, record_id string, uri string, date string, type string, payload_bytes long, payload_sha1 string, refers_to long, refers_id string, payload binary"


def read_warc(spark, path: str, payload: bool = True) -> DataFrame:
    """The records of gzipped WARC files. Digest and length of a response are those of the block read.

    A revisit has those that its header tells. Files are unzipped record by record. A folder without files gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for fields, block in warc_records(gzip.GzipFile(fileobj=io.BytesIO(data.as_py()))):
                    again = fields["warc-type"] == "revisit"
                    number = lambda name: int(x) if (x := fields.get(name, "-")) != "-" else None  # noqa: E731, B023
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")) if again else hashlib.sha1(block).digest()
                    values = (number("x-key"), fields["warc-type"], fields["warc-record-id"], fields["warc-target-uri"], fields["warc-date"], fields["content-type"], number("x-payload-length") if again else len(block), digest.hex(), number("x-refers-to-key"), fields.get("warc-refers-to"), block if payload and not again else None)
                    rows.append(dict(zip(READ_SCHEMA.names, values)))
                    size += len(block)
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=READ_SCHEMA)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=READ_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return workers_know(files).select("content").mapInArrow(run, READ)


def _arrow(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ") for x in columns.split(", "))])


SCHEMA, READ_SCHEMA = _arrow(RECORD), _arrow(READ)
