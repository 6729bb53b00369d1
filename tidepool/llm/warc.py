"""WARC archives: a Spark sink, and a source that splits compressed files.

``df.write.format("warc")`` and ``spark.read.format("warc")`` after ``register(spark)``.

*Writing.* Each task writes ``.warc.gz`` files of one gzip member a record, new ones after
``fileBytes``, into a staging folder; the commit on the driver moves the files that tasks
have reported into place, so failed and repeated tasks leave nothing. A ``revisit`` record
holds the HTTP header only, the digest of the full payload, and the record that it refers
to. Inside a member the bytes of the gzip magic never stand next to each other
uncompressed (the stream is flushed between them), so that a payload that is an archive
itself cannot be taken for a record.

*Reading.* Files are cut into ranges of ``splitBytes``. A task scans its range for the gzip
magic, takes a candidate for a record only if it inflates to a WARC header and to its
own end, with right checksum and lengths, and goes on behind it. It owns the records whose
member starts inside its range, to their end, wherever that lies. Damaged members are
skipped; the scan takes up again at the next magic. ``intact`` says whether the payload
has the stated digest. Memory is bounded by the longest record.

Input columns of the sink: ``record_id, uri, record_type, refers_to, payload_bytes,
payload_digest`` (lower-case hex SHA-1), ``payload``; further columns are not allowed.
``with_revisits`` makes them from a table of pages. The source gives these, the ``path``
and ``offset`` of the member, and ``intact``; without payloads if the option ``payload`` is false.

Cases: a null payload is written as the empty one; a null uri or id is left out of the
record (ids then come from a random uuid) and read as null; control characters of a uri are percent-encoded; an
empty table gives an empty folder, an empty or missing folder no rows; repeated rows give
repeated records. Of rows that tie for the largest id of a payload, all are responses; a
null id is smaller than any other, and revisits the largest one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import time
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import common

#: Payloads below this size are never stored as revisits.
LEAST_BYTES = 1000
FILE_BYTES = 1 << 30
SPLIT_BYTES = 64 << 20
#: Bytes read, and bytes inflated, at a time.
READ_BYTES, PIECE_BYTES = 1 << 20, 16 << 10
#: Payload bytes of a batch that the source yields.
BATCH_BYTES = 2 << 20

MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

WRITTEN = (
    "record_id string, uri string, record_type string, refers_to string, "
    "payload_bytes bigint, payload_digest string, payload binary"
)
_PLACE = "path string, offset bigint, record_id string, uri string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, intact boolean"


# Records


def _fields(pairs: list[tuple[str, object]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in pairs if v is not None)


def _clean(uri: str | None) -> str | None:
    """The uri with control characters percent-encoded: none can end a header line."""
    return uri and re.sub(r"[\x00-\x20\x7f]", lambda m: urllib.parse.quote(m[0], safe=""), uri)


def _sealed(content: bytes) -> bytes:
    """One gzip member that holds ``content`` and the magic's bytes nowhere else uncompressed."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    out, at = [], 0
    while (hit := content.find(MAGIC, at)) >= 0:
        out += [squeeze.compress(content[at : hit + 1]), squeeze.flush(zlib.Z_SYNC_FLUSH)]
        at = hit + 1
    return b"".join([*out, squeeze.compress(content[at:]), squeeze.flush()])


def record(date: str, record_id, uri, record_type, refers_to, payload_bytes, payload_digest, payload) -> bytes:
    """The gzip member of one response or revisit."""
    payload = payload or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes
    body = http + (payload if record_type == "response" else b"")
    head = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<{record_id}>" if record_id is not None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _clean(uri)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(payload_digest)).decode()),
        ("WARC-Profile", _PROFILE if record_type == "revisit" else None),
        ("WARC-Refers-To", f"<{refers_to}>" if refers_to is not None else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(body)),
    ]
    return _sealed(b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + body + b"\r\n\r\n")


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in block.split(b"\r\n")[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]] | None:
    """Headers and blocks of the records in an inflated member; None if it is not made of whole records."""
    out, at = [], 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/", at):
            return None
        head = _headers(content[at:end])
        size = head.get("content-length", "")
        stop = end + 4 + int(size) if size.isascii() and size.isdigit() else len(content)
        if content[stop : stop + 4] != b"\r\n\r\n":
            return None
        out.append((head, content[end + 4 : stop]))
        at = stop + 4
    return out or None


def _digest(head: dict[str, str]) -> str | None:
    kind, _, value = head.get("warc-payload-digest", "").partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return (bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())).hex()
    except ValueError:
        return None


def _bare(value: str | None) -> str | None:
    """An id without its angle brackets; ids that the sink made up are null again."""
    value = value and value.strip("<>")
    return None if value is None or value.startswith("urn:uuid:") else value


def described(head: dict[str, str], block: bytes) -> dict:
    """The source's columns of one record."""
    payload, size = block, len(block)
    if head.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        size = int(_headers(top).get("content-length", len(payload)))
    kind, digest = head.get("warc-type"), _digest(head)
    revisit = kind == "revisit"
    return {
        "record_id": _bare(head.get("warc-record-id")),
        "uri": head.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _bare(head.get("warc-refers-to")),
        "payload_bytes": size if revisit else len(payload),
        "payload_digest": digest,
        "intact": None if revisit or digest is None else hashlib.sha1(payload).hexdigest() == digest,
        "payload": None if revisit else payload,
    }


# Scanning


class Scan:
    """Members of a file, found from any place in it. ``read(at, n)`` gives bytes of the file."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        self.base, self.held = 0, b""

    def piece(self, at: int, n: int) -> bytes:
        if not (self.base <= at and at + min(n, self.size - at) <= self.base + len(self.held)):
            self.base, self.held = at, self.read(at, max(n, READ_BYTES))
        return self.held[at - self.base : at - self.base + n]

    def next_magic(self, at: int, end: int) -> int | None:
        """The first magic that starts at ``at`` or later, before ``end``."""
        while at < end:
            held = self.piece(at, PIECE_BYTES)
            hit = held.find(MAGIC)
            if hit >= 0:
                return at + hit if at + hit < end else None
            if at + len(held) >= self.size:
                return None
            at += len(held) - len(MAGIC) + 1
        return None

    def member(self, at: int) -> tuple[bytes, int] | None:
        """Content and end of the member at ``at``, if it inflates whole and begins as a record."""
        inflate, out, first = zlib.decompressobj(31), [], b""
        while not inflate.eof:
            held = self.piece(at, PIECE_BYTES)
            if not held:
                return None
            try:
                out.append(inflate.decompress(held))
            except zlib.error:
                return None
            at += len(held)
            if len(first) < 5:
                first += out[-1][:5]
                if not first.startswith(b"WARC/"[: len(first)]):
                    return None
        return b"".join(out), at - len(inflate.unused_data)

    def records(self, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
        """Place, headers and block of the records whose member starts in the range."""
        at = self.next_magic(start, end)
        while at is not None:
            found = self.member(at)
            parsed = parse(found[0]) if found else None
            if parsed:
                yield from ((at, *r) for r in parsed)
            at = self.next_magic(found[1] if parsed else at + 1, end)


# Spark source and sink


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(path)
    return fs, path.rstrip("/")


def _files(path: str) -> list[pafs.FileInfo]:
    fs, folder = _folder(path)
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted((x for x in found if x.is_file and x.base_name.endswith(".warc.gz")), key=lambda x: x.path)


@dataclass
class Range(InputPartition):
    path: str
    size: int
    start: int
    end: int

    def __init__(self, path: str, size: int, start: int, end: int):
        super().__init__((path, start))
        self.path, self.size, self.start, self.end = path, size, start, end


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))
        self.columns = [f.name for f in schema.fields]

    def partitions(self) -> list[Range]:
        cuts = [(x, range(0, x.size, self.split)) for x in _files(self.path)]
        found = [Range(x.path, x.size, s, min(s + self.split, x.size)) for x, starts in cuts for s in starts]
        return found or [Range("", 0, 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, _ = _folder(self.path)
        with fs.open_input_file(part.path) as f:
            scan = Scan(lambda at, n: f.read_at(min(n, part.size - at), at) if at < part.size else b"", part.size)
            rows, held = [], 0
            for at, head, block in scan.records(part.start, part.end):
                row = {"path": part.path, "offset": at, **described(head, block)}
                rows.append({k: row[k] for k in self.columns})
                held += (len(block) if "payload" in self.columns else 0) + 500
                if held >= BATCH_BYTES:
                    yield self.batch(rows)
                    rows, held = [], 0
            if rows:
                yield self.batch(rows)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "intact": pa.bool_(), "payload": pa.binary()}
        return pa.RecordBatch.from_pylist(rows, pa.schema([(k, kinds.get(k, pa.string())) for k in self.columns]))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.most = int(options.get("fileBytes", FILE_BYTES))
        self.date = options.get("date", time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _folder(self.path)
        names, out = [], None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        fs.create_dir(f"{folder}/{self.staging}", recursive=True)
                        out, held = fs.open_output_stream(f"{folder}/{self.staging}/{names[-1]}", compression=None), 0
                        held += out.write(_info(self.date, names[-1]))
                    held += out.write(record(self.date, **row))
                    if held >= self.most:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
            common.release_memory()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = _folder(self.path)
        old = _files(self.path) if self.overwrite else []
        fs.create_dir(folder, recursive=True)
        for message in messages:
            for name in message.names if message else []:
                fs.move(f"{folder}/{self.staging}/{name}", f"{folder}/{name}")
        for x in old:
            fs.delete_file(x.path)
        self.clear(fs, folder)

    def abort(self, messages: list[Written | None]) -> None:
        self.clear(*_folder(self.path))

    def clear(self, fs: pafs.FileSystem, folder: str) -> None:
        """Away with what failed and repeated tasks have left."""
        if fs.get_file_info(f"{folder}/{self.staging}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{folder}/{self.staging}")


def _info(date: str, name: str) -> bytes:
    """The record that opens a file."""
    body = b"format: WARC File Format 1.1\r\n"
    head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name)]
    head += [("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]
    return _sealed(b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + body + b"\r\n\r\n")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _PLACE + (", payload binary" if self.options.get("payload", "true").lower() == "true" else "")

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def with_revisits(pages: DataFrame, id_col: str, payload: Column, uri_col: str = "url", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The sink's columns: of pages with equal payloads of ``least_bytes`` or more, that with the
    largest id is the response and the others revisit it. Record ids are ``urn:page:<id>``.

    Equal means equal SHA-256. Only payloads that several pages share take part in the join's
    small side: one row each, after map-side aggregation.
    """
    named = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    own = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), F.coalesce(payload, F.lit(b"")).alias("payload"))
    large = F.when(F.octet_length("payload") >= least_bytes, F.sha2("payload", 256))
    shared = own.select("id", large.alias("same")).where("same IS NOT NULL").groupBy("same").agg(F.max("id").alias("last"), F.count("*").alias("n"))
    # small payloads have no twin to meet: spread over all tasks, not gathered under null
    meets = F.coalesce(large, F.concat(F.lit("small "), F.xxhash64("id", "uri").cast("string")))
    met = own.withColumn("same", meets).join(shared.where("n > 1").select("same", "last"), "same", "left")
    revisit = F.col("last").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("last")))
    return met.select(
        named(F.col("id")).alias("record_id"),
        "uri",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, named(F.col("last"))).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write(records: DataFrame, path: str, **options) -> None:
    """Writes the sink's columns as archives."""
    register(records.sparkSession)
    records.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(common.BATCH_BYTES))
    records.write.format("warc").mode("append").options(**options).save(path)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """The records of the archives in a folder."""
    register(spark)
    return spark.read.format("warc").options(**options).load(path)
