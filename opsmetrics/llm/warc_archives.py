"""WARC records in ZIP packages: writing, and reading by ranges.

A package holds `archive/data.warc.gz`, each record a gzip member of its own, and
`indexes/index.cdx`, a line per record with its place. Both are stored, not
compressed, so a record is one range of the package.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.llm.common import attach, new_folder, staged
from opsmetrics.llm.zip_ranges import (
    STORED,
    Member,
    data_start,
    members,
    open_ranges,
    read_range,
)

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
MEMBER = re.compile(r"archive/.+\.warc\.gz")
# Bytes of a range that are decompressed at a time.
PIECE = 1 << 14
# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

# A package is closed beyond so many bytes of records.
PACKAGE_BYTES = 128 << 20
# Neighbouring records are read at once up to so many bytes.
SPAN_BYTES = 4 << 20
LEVEL = 6

FOUND = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, archive string, offset long"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _page(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool
) -> bytes:
    """One record, compressed by itself. A revisit keeps the header of the answer,
    with the payload's length, but not the payload."""
    answer = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = answer if revisit else answer + payload
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_page(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if revisit:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_page(refers_to)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode().split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _page_id(text: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(found[1]) if found else None


def parsed_record(data: bytes) -> dict:
    """A record's fields, with its payload checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    answer, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(_fields(answer)["content-length"])
    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not what was written")
    return {
        "page_id": _page_id(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_id(fields.get("warc-refers-to")),
    }


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, first_id, revisit): of equal payloads of at least
    `least_bytes`, the smallest page_id is the response, the others revisit it.

    Rows that repeat the smallest page_id are responses each; a missing page_id
    is never the smallest unless there is no other. Only digests that occur
    more than once are joined back.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "_digest", F.when(F.length("payload") >= least_bytes, F.sha1("payload"))
    )
    repeated = (
        rows.filter(F.col("_digest").isNotNull()).groupBy("_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").drop("_n")
    )
    marked = attach(rows, staged(repeated, "warc-repeated"), ["_digest"])
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return marked.select("page_id", "url", "payload", "first_id", revisit.alias("revisit"))


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES
) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html; missing html is empty)
    and return (archive, records) of the finished packages.

    Each try of a task writes packages with names of its own, and only those
    of the try that succeeds are listed: one left by a lost executor is never
    read. A package is streamed; a task holds one record at a time.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        package = None
        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    package = _Package(system, path, folder)
                package.add(row)
                if package.size >= package_bytes:
                    yield package.closed()
                    package = None
        if package is not None:
            yield package.closed()

    marked = with_revisits(pages, least_bytes)
    return staged(marked.mapInArrow(written, "archive string, records long"), "warc-packages")


class _Package:
    def __init__(self, system: fs.FileSystem, path: str, folder: str):
        name = f"pages-{uuid.uuid4().hex}.zip"
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.stream = system.open_output_stream(f"{path.rstrip('/')}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index = io.BytesIO()
        self.size = self.records = 0

    def add(self, row: dict) -> None:
        refers_to = row["first_id"] if row["revisit"] else None
        record = record_bytes(row["page_id"], row["url"], row["payload"], refers_to, row["revisit"])
        self.data.write(record)
        self.index.write(f"{row['page_id']} {self.size} {len(record)}\n".encode())
        self.size += len(record)
        self.records += 1

    def closed(self) -> pa.RecordBatch:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), self.index.getvalue())
        self.zip.close()
        self.stream.close()
        return pa.RecordBatch.from_pydict({"archive": [self.uri], "records": [self.records]})


def _index_lines(file: pa.NativeFile, start: int, size: int, chunk: int = 1 << 20) -> Iterator[bytes]:
    held = b""
    for at in range(start, start + size, chunk):
        *lines, held = (held + read_range(file, at, min(chunk, start + size - at))).split(b"\n")
        yield from lines
    if held:
        yield held


def _scanned(file: pa.NativeFile, start: int, size: int, chunk: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(place, length) of the gzip members of a file without an index."""
    at = begin = start
    unpacker, held = zlib.decompressobj(31), b""
    while at < start + size or held:
        if not held:
            held = read_range(file, at, min(chunk, start + size - at))
            at += len(held)
        unpacker.decompress(held)
        held = unpacker.unused_data
        if unpacker.eof:
            yield begin - start, at - len(held) - begin
            begin, unpacker = at - len(held), zlib.decompressobj(31)
    if begin != start + size:
        raise ValueError("the last record is cut off")


def record_spans(archives: DataFrame, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """(archive, start, length): ranges of whole neighbouring records of at most
    about `span_bytes`, from the directories and indexes of the packages.

    All members `archive/*.warc.gz` are read. Where the package has an index of
    this library's making, it names the records of its member; other members are
    scanned for theirs. Members that the package holds compressed cannot be
    read by ranges and fail, as does a package without any such member.
    """

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with open_ranges(archive) as file:
                    found = {m.name: m for m in members(file)}
                    data = [m for name, m in found.items() if MEMBER.fullmatch(name)]
                    if not data:
                        raise ValueError(f"{archive} has no member archive/*.warc.gz")
                    for member in data:
                        index = found.get(INDEX) if member.name == DATA else None
                        if any(m.method != STORED for m in (member, index) if m):
                            raise ValueError(f"members of {archive} are compressed")
                        yield _spans_of(file, archive, member, index, span_bytes)

    return archives.select("archive").mapInArrow(spans, "archive string, start long, length long")


def _spans_of(
    file: pa.NativeFile, archive: str, member: Member, index: Member | None, span_bytes: int
) -> pa.RecordBatch:
    base = data_start(file, member)
    if index:
        lines = _index_lines(file, data_start(file, index), index.size)
        places = (tuple(map(int, line.split()[-2:])) for line in lines)
    else:
        places = _scanned(file, base, member.size)
    rows, start, end = [], None, 0
    for place, length in places:
        if start is not None and (place != end or place + length - start > span_bytes):
            rows.append((archive, base + start, end - start))
            start = None
        start = place if start is None else start
        end = place + length
    if start is not None:
        rows.append((archive, base + start, end - start))
    names = ("archive", "start", "length")
    return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], _SPANS)


_SPANS = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64())])


def records_in(archive: str, start: int, length: int) -> Iterator[dict]:
    """The records of one range of a package."""
    with open_ranges(archive) as file:
        held = memoryview(read_range(file, start, length))
    at = 0
    while at < length:
        begin, unpacker, parts = at, zlib.decompressobj(31), []
        while not unpacker.eof:
            # In pieces, so that what follows a record is not copied with each one.
            if at == length:
                raise ValueError(f"a record of {archive} is cut off")
            piece = held[at : at + PIECE]
            parts.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        yield parsed_record(b"".join(parts)) | {"archive": archive, "offset": start + begin}


def read_archives(archives: DataFrame, payloads: bool = True, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """A row per record of the packages in `archives` (archive: URI): page_id, url,
    payload (missing for revisits, and everywhere without `payloads`),
    payload_bytes, payload_digest, record_type, refers_to, archive, offset.

    Packages are opened once for their directory and index, and their ranges
    are dealt out anew, so that one large package is read by many tasks.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()),
            ("offset", pa.int64()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in batch.to_pylist():
                rows = list(records_in(span["archive"], span["start"], span["length"]))
                if not payloads:
                    rows = [r | {"payload": None} for r in rows]
                yield pa.RecordBatch.from_pylist(rows, schema)

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = record_spans(archives, span_bytes).repartition(parts, "archive", "start")
    return spans.mapInArrow(read, FOUND)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(archive) of the packages in a folder; their contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    return listed.select(F.col("path").alias("archive"))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write `pages` into packages in the shared folder and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    found = read_archives(write_archives(pages, folder), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
