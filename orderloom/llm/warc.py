"""Pages to WARC archives and back, payloads as a table of chunks.

Writing: of pages with equal payloads the one with the largest id becomes a
response record, the others become revisit records that refer to it. Which page
that is comes from a grouped maximum over digests; only the table of revisits is
joined back, so texts are not shuffled. Each task streams its pages into archive
files of its own, one gzip member per record, payloads in slices.

Reading: every record becomes rows (record, chunk number) of at most ``chunk``
payload bytes. A row carries the SHA-1 of the payload up to its end, so a reader
can check a payload while it passes and the last row has the digest of the whole
one. Neither side holds more of a payload than a slice, beyond the row that
Spark hands over.

Defined cases: a null html is an empty payload; a null url is left out; pages
without an id are responses; pages that share the largest id of a group are all
responses; payloads below ``least_bytes`` are never revisits.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.files import Sink, open_input, own_file
from orderloom.llm.rows import attach_left
from orderloom.llm.words import bytewise
from orderloom.operators.storage import materialize, new_folder

MOST_READERS = 50_000
CHUNK = 1 << 16
FILE_BYTES = 128 << 20
# Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of bytes in upper-case base 32, without a Python step."""
    digits = F.sha1(payload)
    out = []
    for k in range(0, 40, 5):  # five hexadecimal digits are four of base 32
        part = F.conv(F.substring(digits, k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.lit(BASE32).substr(F.shiftright(part, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def _plan(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with ``payload_bytes``, ``payload_digest`` and, for revisits, ``refers_to``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    shaped = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("html"))
    facts = shaped.select(
        "page_id",
        F.octet_length("html").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("html").cast("binary")).alias("payload_digest"),
    )
    facts = materialize(facts, "payloads")
    able = facts.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    groups = able.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    revisits = able.join(groups.where("n > 1"), "payload_digest").where("page_id != refers_to")
    revisits = materialize(revisits.select("page_id", "payload_digest", "refers_to").distinct(), "revisits")
    told = shaped.withColumns({
        "payload_bytes": F.octet_length("html").cast("bigint"),
        "payload_digest": base32_sha1(F.col("html").cast("binary")),
    })
    return attach_left(told, revisits, ("page_id", "payload_digest"))


def _record_id(page_id, file: str, number: int) -> str:
    """Pages with an id have a record id that follows from it, so that revisits can name it."""
    name = f"page:{page_id}" if page_id is not None else f"{file}:{number}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _clean(url: str) -> str:
    """Control characters and blanks would break the header."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


class ArchiveWriter:
    """One archive file; payloads are written in slices."""

    def __init__(self, path: str, date: str, level: int = 6):
        self.sink, self.date, self.level, self.records = Sink(path), date, level, 0
        self._record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, path, 0)),
                      ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", [], 0)

    def _record(self, fields: list, start: bytes, slices, length: int) -> None:
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        fields = [*fields, ("WARC-Date", self.date), ("Content-Length", len(start) + length)]
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
        for part in (head.encode(), start):
            self.sink.write(packer.compress(part))
        for part in slices:
            self.sink.write(packer.compress(part))
        self.sink.write(packer.compress(b"\r\n\r\n") + packer.flush())
        self.records += 1

    def page(self, page_id, url, html: str, length: int, digest: str, refers_to) -> None:
        revisit = refers_to is not None
        fields = [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _record_id(page_id, self.sink.path, self.records)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Payload-Length", length),
        ]
        fields += [("WARC-Target-URI", _clean(url))] if url else []
        fields += [("Page-Id", page_id)] if page_id is not None else []
        if revisit:
            fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, "", 0)), ("Refers-To-Page", refers_to)]
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
        slices = (html[a : a + CHUNK].encode() for a in range(0, 0 if revisit else len(html), CHUNK))
        self._record(fields, http, slices, 0 if revisit else length)

    def close(self) -> None:
        self.sink.close()


def _writing(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None

        def finish(done: ArchiveWriter) -> pa.RecordBatch:
            done.close()
            return pa.RecordBatch.from_pydict({"file": [done.sink.path], "records": [done.records], "bytes": [done.sink.size]})

        for batch in bytewise(batches, "html"):
            rows = zip(*(batch.column(c) for c in ("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")))
            for row in rows:
                writer = writer or ArchiveWriter(own_file(folder, ".warc.gz"), date)
                writer.page(*(x.as_py() for x in row))
                if writer.sink.size >= file_bytes:
                    yield finish(writer)
                    writer = None
        if writer is not None:
            yield finish(writer)

    return run


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) into ``folder``; returns the written list of
    archives ``file, records, bytes``. Files of lost attempts are not in the list."""
    folder = folder or new_folder(pages.sparkSession, "archives")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    plan = _plan(pages, least_bytes).select("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")
    written = plan.mapInArrow(_writing(folder, date, file_bytes), "file string, records bigint, bytes bigint")
    return materialize(written, "archive-list")


def records(path: str) -> Iterator[tuple[dict[str, str], int, io.BufferedReader]]:
    """Each record's header fields, the length of its block and the stream at its start."""
    with open_input(path) as file, io.BufferedReader(gzip.GzipFile(fileobj=file), 1 << 17) as stream:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: not a WARC record: {line[:40]!r}")
            fields = {}
            while (line := stream.readline()).strip():
                name, _, value = line.decode().partition(":")
                fields[name.lower()] = value.strip()
            length = int(fields["content-length"])
            yield fields, length, stream


def _skip(stream, length: int) -> None:
    while length:
        length -= len(stream.read(min(length, CHUNK)))


_CHUNK_TYPES = (
    "file string, record_no bigint, record_id string, record_type string, url string, page_id string, "
    "refers_to string, declared_bytes bigint, declared_digest string, chunk_no bigint, chunk_start bigint, "
    "data binary, digest string, last boolean"
)


def _chunks(path: str, chunk: int) -> Iterator[tuple]:
    for number, (fields, length, stream) in enumerate(records(path)):
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            _skip(stream, length)
            continue
        while length:  # the headers of the transfer are not payload
            line = stream.readline()
            length -= len(line)
            if not line.strip():
                break
        shared = (
            path, number, fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields.get("page-id"),
            fields.get("refers-to-page"), int(fields["payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:"),
        )
        digest, k, start = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, length))
            if len(data) < min(chunk, length):
                raise ValueError(f"{path}: record {number} ends too early")
            length -= len(data)
            digest.update(data)
            yield (*shared, k, start, data, base64.b32encode(digest.copy().digest()).decode(), not length)
            k, start = k + 1, start + len(data)
            if not length:
                break


def _reading(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _CHUNK_TYPES.split(", ")]
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("file").to_pylist():
                for row in _chunks(path, chunk):
                    rows.append(row)
                    held += len(row[11]) + 512
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays(_arrays(rows), names=names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(_arrays(rows), names=names)

    return run


def _arrays(rows: list[tuple]) -> list[pa.Array]:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    types = [kinds[x.split()[1]] for x in _CHUNK_TYPES.split(", ")]
    return [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]


def read_chunks(spark: SparkSession, archives: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of all ``archives`` (column ``file``): one row per record and chunk number, with
    the chunk's bytes, where it starts in the payload and the digest of the payload up to its end."""
    # As many tasks as archives: rows this small would otherwise be read by one task.
    spread = archives.select("file").repartition(max(1, min(MOST_READERS, archives.count())), F.xxhash64("file"))
    return spread.mapInArrow(_reading(chunk), _CHUNK_TYPES)


def page_digests(chunks: DataFrame, kind: str = "bigint") -> DataFrame:
    """One row per record from its last chunk. A response's size and digest are those of the bytes
    read, which must be the declared ones; a revisit holds no payload and has them declared."""
    own = F.col("record_type") == "response"
    size = F.when(own, F.col("chunk_start") + F.length("data")).otherwise(F.col("declared_bytes"))
    digest = F.when(own, F.col("digest")).otherwise(F.col("declared_digest"))
    wrong = own & ((size != F.col("declared_bytes")) | (digest != F.col("declared_digest")))
    error = F.raise_error(F.concat(F.lit("payload differs from its record: "), F.col("record_id")))
    return chunks.where("last").select(
        F.col("page_id").cast(kind).alias("page_id"),
        F.when(wrong, error.cast("bigint")).otherwise(size).alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
