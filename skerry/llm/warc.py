"""WARC archives written from and read back into chunked record tables.

A record is never one value: writing takes rows (record, chunk number, bytes)
and reading gives such rows again, with a digest that is carried from chunk to
chunk. Neither side holds a whole payload; a reader holds one chunk.

Equal payloads are stored once. The page with the greatest id is the response,
the other pages are revisits that refer to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skerry.llm.shared import stored
from skerry.workspace import make_dirs, scratch

CHUNK_BYTES = 16_384
# Chunk rows handed to Spark at a time by a reader.
READ_ROWS = 256
ARCHIVE_DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "path string, records bigint, bytes bigint"
CHUNKS = (
    "record_id string, page_id bigint, record_type string, refers_to bigint, chunk_no bigint, last boolean,"
    " payload_bytes bigint, payload_digest string"
)


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def open_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def chunk_rows(pages: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(page_id, url, sha1, size, chunk_no, data): payload pieces of at most `chunk` bytes, one empty piece for none."""
    whole = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"))
    pieces = F.greatest(F.ceil(F.col("size") / chunk), F.lit(1)).cast("int")
    at = whole.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), pieces - 1)))
    data = F.substring(F.col("payload"), F.col("chunk_no") * chunk + 1, F.lit(chunk))
    return at.select("page_id", "url", "sha1", "size", "chunk_no", data.alias("data"))


def choose_responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, sha1, size, copies, response_id): which page holds each payload.

    Payloads under `least_bytes` are stored by every page. Rows of equal id and
    payload are counted in `copies`; one of them is the record, the others
    revisit it.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    records = (
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            F.sha1(payload).alias("sha1"),
            F.octet_length(payload).cast("long").alias("size"),
        )
        .groupBy("page_id", "sha1", "size")
        .agg(F.count("*").alias("copies"))
    )
    # The greatest id per payload is reduced on the map side; only the copies of a payload are read twice.
    greatest = records.groupBy("sha1").agg(F.max("page_id").alias("response_id"))
    chosen = F.when(F.col("size") >= least_bytes, F.col("response_id")).otherwise(F.col("page_id"))
    return records.join(greatest, "sha1").select("page_id", "sha1", "size", "copies", chosen.alias("response_id"))


def _head(fields: list[tuple[str, object]], length: int) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields), f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


def _record_id(page, sha1: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page}/{sha1}/{copy}')}>"


class ArchiveWriter:
    """Writes records one chunk after another to one archive; each record is a gzip member of its own."""

    def __init__(self, sink: BinaryIO) -> None:
        self.sink, self.bytes, self.records, self.open = sink, 0, 0, False
        self.packer = zlib.compressobj(wbits=31)
        info = b"software: skerry\r\nformat: WARC File Format 1.1\r\n"
        fields = [("WARC-Type", "warcinfo"), ("WARC-Date", ARCHIVE_DATE), ("WARC-Record-ID", _record_id("info", "", 0))]
        self._put(_head([*fields, ("Content-Type", "application/warc-fields")], len(info)) + info)
        self._close_member()

    def _put(self, data: bytes) -> None:
        self._write(self.packer.compress(data))

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def _close_member(self) -> None:
        self._put(b"\r\n\r\n")
        self._write(self.packer.flush())
        self.packer = zlib.compressobj(wbits=31)

    def begin(self, page, url: str | None, sha1: str, size: int, response, copy: int) -> None:
        """Start the record of a page; a revisit has a header only."""
        revisit = copy > 0 or page != response
        target = " ".join((url or "").split()) or f"urn:page:{page}"
        fields: list[tuple[str, object]] = [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Target-URI", target),
            ("WARC-Date", ARCHIVE_DATE),
            ("WARC-Record-ID", _record_id(page, sha1, copy)),
            ("WARC-Payload-Digest", f"sha1:{base32_sha1(sha1)}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("X-Payload-Length", size),
        ]
        if page is not None:
            fields.append(("X-Page-ID", page))
        if revisit:
            fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
            fields.append(("WARC-Refers-To", _record_id(response, sha1, 0)))
            if response is not None:
                fields.append(("X-Refers-To-Page-ID", response))
        block = HTTP_HEAD.format(size).encode()
        self._put(_head(fields, len(block) + (0 if revisit else size)) + block)
        self.records += 1
        self.open = True

    def chunk(self, data: bytes) -> None:
        self._put(data)

    def end(self) -> None:
        if self.open:
            self._close_member()
            self.open = False


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Write `pages` as WARC files under `folder`; the manifest (path, records, bytes) of the files that count.

    One shuffle brings the chunks of a record, its decision first, to one task,
    sorted. A task that is run again writes another file; only files of the
    stored manifest are read.
    """
    make_dirs(pages.sparkSession, folder)
    decisions = choose_responses(pages, least_bytes).select(
        "page_id", "sha1", "size", F.lit(-1).alias("chunk_no"), "copies", "response_id"
    )
    rows = (
        chunk_rows(pages, chunk)
        .unionByName(decisions, allowMissingColumns=True)
        .repartition("page_id", "sha1")
        .sortWithinPartitions("page_id", "sha1", "chunk_no", "url")
    )
    types = to_arrow_schema(StructType.fromDDL(MANIFEST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
        sink = writer = None
        key = decision = None
        written = -1
        for batch in batches:
            for at in range(batch.num_rows):
                page, url, sha1, size, number, data, copies, response = (c[at].as_py() for c in batch.columns)
                if writer is None:
                    system, name = open_system(path)
                    sink = system.open_output_stream(name, compression=None)
                    writer = ArchiveWriter(sink)
                if number == -1:
                    writer.end()
                    key, decision, written = (page, sha1), (copies, response), -1
                    continue
                if number <= written:
                    continue  # the same chunk of a repeated row
                if written == -1:
                    if key != (page, sha1):
                        raise ValueError(f"page {page} has no decision")
                    for copy in range(1, decision[0]):
                        writer.begin(page, url, sha1, size, decision[1], copy)
                        writer.end()
                    writer.begin(page, url, sha1, size, decision[1], 0)
                written = number
                if page == decision[1]:
                    writer.chunk(data)
        if writer is not None:
            writer.end()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(([path], [writer.records], [writer.bytes]), types.types)], schema=types
            )

    columns = ["page_id", "url", "sha1", "size", "chunk_no", "data", "copies", "response_id"]
    return stored(rows.select(*columns).mapInArrow(run, MANIFEST), "warc-manifest")


def _headers(source: BinaryIO) -> dict[str, str] | None:
    line = source.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields = {}
    while (line := source.readline().rstrip(b"\r\n")):
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def stream_records(source: BinaryIO, chunk: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(headers, chunk number, last, bytes so far, digest so far, data) for every payload chunk of an archive."""
    while (fields := _headers(source)) is not None:
        left = int(fields["content-length"])
        if fields["warc-type"] in ("response", "revisit"):
            while (line := source.readline()) not in (b"\r\n", b""):
                left -= len(line)
            left -= len(line)
        digest, done, number = hashlib.sha1(), 0, 0
        while True:
            data = source.read(min(chunk, left))
            if len(data) < min(chunk, left):
                raise ValueError("the archive ends inside a record")
            left -= len(data)
            done += len(data)
            digest.update(data)
            yield fields, number, left == 0, done, digest.copy(), data
            number += 1
            if left == 0:
                break
        if source.read(4) != b"\r\n\r\n":
            raise ValueError("a record is not closed")


def read_archives(manifest: DataFrame, chunk: int = CHUNK_BYTES, with_data: bool = False) -> DataFrame:
    """Chunk rows of all records: record_id, page_id, record_type, refers_to, chunk_no, last, payload_bytes, payload_digest.

    `payload_bytes` and `payload_digest` are carried along: those of the row
    marked `last` are of the full payload and were compared with the header. A
    revisit is one row with the values of the payload it refers to. With
    `with_data` the bytes of the chunk follow.
    """
    schema = CHUNKS + ", data binary" * with_data
    types = to_arrow_schema(StructType.fromDDL(schema))

    def number(text: str | None) -> int | None:
        return int(text) if text is not None else None

    def rows(path: str) -> Iterator[tuple]:
        system, name = open_system(path)
        with system.open_input_file(name) as raw, gzip.GzipFile(fileobj=raw) as members, io.BufferedReader(members) as source:
            for fields, at, last, done, digest, data in stream_records(source, chunk):
                if fields["warc-type"] == "warcinfo":
                    continue
                stated = fields["warc-payload-digest"].removeprefix("sha1:")
                so_far = base64.b32encode(digest.digest()).decode()
                if fields["warc-type"] == "revisit":
                    done, so_far = int(fields["x-payload-length"]), stated
                elif last and so_far != stated:
                    raise ValueError(f"record {fields['warc-record-id']} does not match its digest")
                row = (
                    fields["warc-record-id"],
                    number(fields.get("x-page-id")),
                    fields["warc-type"],
                    number(fields.get("x-refers-to-page-id")),
                    at,
                    last,
                    done,
                    so_far,
                )
                yield (*row, data) if with_data else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in rows(path):
                    held.append(row)
                    if len(held) >= READ_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), types.types)], schema=types)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), types.types)], schema=types)

    # One task per archive: a stated number, because adaptive execution would merge so few bytes into one task.
    archives = manifest.count()
    return manifest.select("path").repartition(max(1, archives)).mapInArrow(run, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives and read them back, one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to. A NULL html
    is the empty payload, equal to any other empty one. A NULL page_id counts as
    smaller than all others. Repeated rows give one record and revisits of it.
    An empty table writes no archive. Other columns are not looked at.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, least_bytes, chunk)
    last = read_archives(manifest, chunk).where("last")
    return last.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
