"""Write page payloads as WARC files, and read them back by reassembling segments.

Writing: every row becomes a record of its own gzip member. A payload that several rows share
is stored once, by the row with the smallest id; the others become revisit records that name
it. A record whose block is longer than a segment goes on in continuation records, and response
bodies are framed as HTTP chunks. Each task streams its rows to a file of its own in the shared
folder and reports the file; the files that count are those of the staged report, so that a
second attempt of a task does no harm. Files are listed in stretches of whole records.

Reading: each stretch is streamed record by record, by a task of its own. Complete records are decoded where they are read;
segments are grouped by the identifier of their origin record, put in order by segment number,
and checked against the total length before the chunks are decoded. A task holds one record at
a time.

Defined results: null html is an empty payload; payloads below ``MIN_SHARED`` bytes are always
stored; rows that repeat both id and payload of the storing row are stored as well; a null id
sorts after all others and comes back as null; a record with a missing segment, a wrong total
length or broken chunks is an error, not a shorter payload. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakezones.llm.text import filesystem, shared_folder, whole
from lakezones.session import scratch_path, stage

MIN_SHARED = 100

# Bytes of a record's block in one segment, of one HTTP chunk, and of one file.
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
FILE_BYTES = 1 << 30
# Bytes of a file that one task reads, and read tasks at most.
STRETCH_BYTES = 64 << 20
MOST_TASKS = 100_000

# Row identifiers up to this number are broadcast (at most about 120 bytes each).
BROADCAST_ROWS = 200_000

# Header lines of the formats.
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "path string, start bigint, length bigint, records bigint"
RECORDS = (
    "origin string, segment int, total_length bigint, record_type string, page_id bigint, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, block binary"
)
BATCH_BYTES = 4 << 20


class BrokenRecordError(ValueError):
    """A record lacks a segment, has another length than stated, or broken chunks."""


def with_storage(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """page_id, url, payload, its digest, and the row that stores the payload in place of this one."""
    payload = F.encode(whole(F.col("html")), "UTF-8")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    ).withColumn("bytes", F.octet_length("payload"))
    large = rows.filter(F.col("bytes") >= min_shared).select("page_id", "digest")
    shared = large.groupBy("digest").agg(F.count("*").alias("rows"), F.min("page_id").alias("first_id"))
    shared = shared.filter("rows > 1 AND first_id IS NOT NULL").select(F.col("digest").alias("of"), "first_id")
    revisits = large.join(shared, F.col("digest") == F.col("of")).filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
    revisits = stage(
        revisits.select(F.col("page_id").alias("again"), "of", F.col("first_id").alias("refers_to")).distinct(),
        "warc-revisits",
    )
    # Payloads are moved only if there are too many revisits to send them to the payloads.
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    same = F.col("page_id").eqNullSafe(F.col("again")) & (F.col("digest") == F.col("of"))
    return rows.join(revisits, same, "left").drop("again", "of", "bytes")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in HTTP chunks."""
    out = io.BytesIO()
    for start in range(0, len(payload), size):
        piece = payload[start : start + size]
        out.write(b"%x\r\n" % len(piece))
        out.write(piece)
        out.write(b"\r\n")
    out.write(b"0\r\n\r\n")
    return out.getvalue()


def dechunked(body: bytes) -> bytes:
    """The payload of HTTP chunks; chunk extensions and trailers are skipped."""
    out, at = io.BytesIO(), 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise BrokenRecordError("a chunk has no length")
        try:
            length = int(body[at:end].split(b";", 1)[0], 16)
        except ValueError:
            raise BrokenRecordError("the length of a chunk is no number") from None
        if length == 0:
            return out.getvalue()
        at = end + 2
        if body[at + length : at + length + 2] != b"\r\n":
            raise BrokenRecordError("a chunk is shorter than its length")
        out.write(body[at : at + length])
        at += length + 2


def _member(headers: dict[str, object], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items() if value is not None)
    head = f"{VERSION}\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode()
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _address(url: str | None) -> str | None:
    """Without characters that would end the header line."""
    return None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)



def members(record_id: str, page_id, url, payload: bytes, digest: str, refers_to, segment_bytes: int) -> Iterator[bytes]:
    """The record of one row, and its continuations."""
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{record_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": _address(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Page-ID": page_id,
    }
    if refers_to is not None:
        headers |= {"WARC-Profile": PROFILE, "Refers-To-Page-ID": refers_to, "Payload-Length": len(payload)}
        yield _member(headers, b"")
        return
    headers["Content-Type"] = "application/http; msgtype=response"
    block = HTTP_HEAD + chunked(payload)
    if len(block) <= segment_bytes:
        yield _member(headers, block)
        return
    yield _member(headers | {"WARC-Segment-Number": 1}, block[:segment_bytes])
    starts = range(segment_bytes, len(block), segment_bytes)
    for number, start in enumerate(starts, 2):
        last = start + segment_bytes >= len(block)
        yield _member(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                "WARC-Date": DATE,
                "WARC-Segment-Origin-ID": f"<urn:uuid:{record_id}>",
                "WARC-Segment-Number": number,
                "WARC-Segment-Total-Length": len(block) if last else None,
            },
            block[start : start + segment_bytes],
        )


@dataclass(frozen=True)
class Writer:
    """Writes the rows of a task to files below ``folder`` and yields one row for each stretch of a file."""

    folder: str
    segment_bytes: int = SEGMENT_BYTES
    file_bytes: int = FILE_BYTES
    stretch_bytes: int = STRETCH_BYTES

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(self.folder)
        store.create_dir(folder, recursive=True)
        rows = (row for batch in batches for row in batch.to_pylist())
        row = next(rows, None)
        while row is not None:
            name, stretches, size = f"{uuid.uuid4()}.warc.gz", [[0, 0, 0]], 0
            with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
                while row is not None and size < self.file_bytes:
                    if stretches[-1][1] >= self.stretch_bytes:
                        stretches.append([size, 0, 0])
                    for member in members(
                        str(uuid.uuid4()), row["page_id"], row["url"], row["payload"], row["digest"],
                        row["refers_to"], self.segment_bytes,
                    ):
                        out.write(member)
                        size += len(member)
                    stretches[-1][1] = size - stretches[-1][0]
                    stretches[-1][2] += 1
                    row = next(rows, None)
            named = [dict(zip(("start", "length", "records"), one), path=f"{self.folder}/{name}") for one in stretches]
            yield pa.RecordBatch.from_pylist(named, _arrow_schema(FILES))


def write_warc(
    rows: DataFrame,
    folder: str,
    segment_bytes: int = SEGMENT_BYTES,
    file_bytes: int = FILE_BYTES,
    stretch_bytes: int = STRETCH_BYTES,
) -> DataFrame:
    """Write what ``with_storage`` gives; the staged list of files, cut into stretches of whole records."""
    rows = rows.select("page_id", "url", "payload", "digest", "refers_to")
    writer = Writer(shared_folder(rows.sparkSession, folder), segment_bytes, file_bytes, stretch_bytes)
    return stage(rows.mapInArrow(writer, FILES), "warc-files")


class _Stretch:
    """The bytes of a file from ``start`` on, ``length`` of them."""

    def __init__(self, file, start: int, length: int):
        self.file, self.left = file, length
        file.seek(start)

    def read(self, size: int) -> bytes:
        data = self.file.read(min(size, self.left))
        self.left -= len(data)
        return data


class _Unpacked:
    """The decompressed bytes of a gzip stream of many members."""

    def __init__(self, stream):
        self.stream, self.packed, self.buffer = stream, b"", b""
        self.unpacker = zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            data = self.packed or self.stream.read(1 << 18)
            if not data:
                return False
            if self.unpacker.eof:
                self.unpacker = zlib.decompressobj(31)
            found = self.unpacker.decompress(data)
            self.packed = self.unpacker.unused_data
            if found:
                self.buffer += found
                return True

    def head(self) -> bytes:
        """Up to the empty line; empty at the end of the file."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise BrokenRecordError("the file ends in the head of a record")
                return b""
        found, self.buffer = self.buffer[:end], self.buffer[end + 4 :]
        return found

    def take(self, length: int) -> bytes:
        parts, size = [self.buffer], len(self.buffer)
        while size < length:
            self.buffer = b""
            if not self._more():
                raise BrokenRecordError("the file ends in a record")
            parts.append(self.buffer)
            size += len(self.buffer)
        joined = b"".join(parts)
        self.buffer = joined[length:]
        return joined[:length]


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record in a file."""
    unpacked = _Unpacked(stream)
    while head := unpacked.head():
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise BrokenRecordError(f"a record starts with {version[:20]!r}")
        headers = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        block = unpacked.take(int(headers["content-length"]))
        if unpacked.take(4) != b"\r\n\r\n":
            raise BrokenRecordError("a record is longer than its length")
        yield headers, block


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, decoded if it is chunked."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise BrokenRecordError("a response has no end of its head")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _described(headers: dict[str, str], block: bytes) -> dict:
    """A row of ``RECORDS``: decoded if the record is complete, else with its block."""
    kind = headers["warc-type"]
    integer = lambda name: int(headers[name]) if name in headers else None
    row = {
        "origin": headers.get("warc-segment-origin-id", headers["warc-record-id"]),
        "segment": integer("warc-segment-number"),
        "total_length": integer("warc-segment-total-length"),
        "record_type": kind,
        "page_id": integer("page-id"),
        "refers_to": integer("refers-to-page-id"),
        "payload_bytes": integer("payload-length"),
        "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha256:"),
        "block": None,
    }
    if row["segment"] is not None:
        row["block"] = block
    elif kind == "response":
        row |= _checked(payload_of(block), row["payload_digest"])
    return row


def _checked(payload: bytes, digest: str) -> dict:
    found = hashlib.sha256(payload).hexdigest()
    if digest and found != digest:
        raise BrokenRecordError(f"a payload has digest {found}, its record says {digest}")
    return {"payload_bytes": len(payload), "payload_digest": found}


def _arrow_schema(columns: str) -> pa.Schema:
    types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, types[kind]) for name, kind in (part.split() for part in columns.split(", "))])


def read_files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of the stretches of files."""
    schema = _arrow_schema(RECORDS)
    for batch in batches:
        for listed in batch.to_pylist():
            store, name = filesystem(listed["path"])
            rows, size = [], 0
            with store.open_input_file(name) as file:
                for headers, block in records_of(_Stretch(file, listed["start"], listed["length"])):
                    row = _described(headers, block)
                    rows.append(row)
                    size += 300 + len(row["block"] or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


RESULT = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
COLUMNS = [part.split()[0] for part in RESULT.split(", ")]


def reassembled(segments: pa.Table) -> pa.Table:
    """One record from the segments of one origin."""
    rows = segments.sort_by("segment").to_pylist()
    numbers, first, last = [row["segment"] for row in rows], rows[0], rows[-1]
    if numbers != list(range(1, len(numbers) + 1)):
        raise BrokenRecordError(f"record {first['origin']} has the segments {numbers[:20]}")
    block = b"".join(row["block"] for row in rows)
    if last["total_length"] is None or len(block) != last["total_length"]:
        raise BrokenRecordError(f"record {first['origin']} has {len(block)} bytes, not {last['total_length']}")
    row = first | _checked(payload_of(block), first["payload_digest"])
    return pa.Table.from_pylist([{name: row[name] for name in COLUMNS}], _arrow_schema(RESULT))


def read_warc(files: DataFrame) -> DataFrame:
    """Every record of the listed files: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Each stretch is read by a task of its own: the tasks are numbered, as adaptive execution would
    merge the few small rows that name them. Ids are never taken for floating point numbers.
    """
    tasks = min(files.count(), MOST_TASKS)
    if not tasks:
        return files.sparkSession.createDataFrame([], RESULT)
    # One row per stretch.
    number = F.row_number().over(Window.orderBy("path", "start")) - 1
    numbered = files.select("path", "start", "length", (number % tasks).cast("int").alias("task"))
    records = numbered.repartitionById(tasks, F.col("task")).mapInArrow(read_files, RECORDS)
    complete = records.filter("segment IS NULL").select(*COLUMNS)
    parts = records.filter("segment IS NOT NULL").select("origin", "segment", "total_length", *COLUMNS, "block")
    return complete.unionByName(parts.groupBy("origin").applyInArrow(lambda segments: reassembled(segments), RESULT))


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages to archives in the shared folder and read these back."""
    folder = shared_folder(pages.sparkSession, scratch_path(pages.sparkSession, "warc"))
    return read_warc(write_warc(with_storage(pages), folder, segment_bytes, file_bytes))
