"""WARC records in ZIP packages: written in parallel, found by the ZIP's directory, read by byte ranges.

A package holds ``archive/data.warc.gz`` (a gzip member for each record) and ``indexes/index.cdxj`` (a line
for each record with its place), both stored without further compression, so that a place in the index is a place
in the package. The reader looks at the end of a package for the directory (the ZIP64 one, where sizes or counts
need it), finds the two members by their entries, reads the index and then only the ranges of records, joined
where they touch. Nothing is extracted.

Of records with equal payloads (by SHA-1, of at least ``least_bytes``) the one with the smallest page_id is a
``response``, the others are ``revisit`` records that refer to it and hold headers only. Hot payloads are
counted before they are shuffled and dealt out again by a salt. A task streams its rows into packages of about
``PACKAGE_BYTES`` in a shared folder, each written under another name first, so that a repeated task
replaces what it wrote before.

Defined results: NULL html is the empty payload. Repeated rows with the smallest page_id are all responses. Rows with
NULL page_id are revisits where another row has an id, else responses, and refer to nothing by themselves. An
empty table gives no packages and no records. Columns other than page_id, url, html are not read; url may be NULL.
The folder must be on a file system that pyarrow opens (local or shared disk, HDFS, object stores).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from uuid import UUID

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 16 << 20
READ_BYTES = 4 << 20
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
    "refers_to long, path string, offset long, length long"
)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{UUID(int=page_id & (1 << 64) - 1)}>" if page_id is not None else "<urn:uuid:ffffffff-ffff-ffff-ffff-ffffffffffff>"


def page_of(record: str | None) -> int | None:
    """The page_id in a record id."""
    n = UUID(record.strip("<>").removeprefix("urn:uuid:")).int if record else 1 << 64
    return None if n >> 64 else n - (1 << 64) * (n >> 63)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head.append(f"WARC-Profile: {REVISIT}")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: {record_id(refers_to)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=3, mtime=0)


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a gzip member; headers in lower case."""
    plain = zlib.decompress(raw, wbits=31)
    fields = lambda head: dict((k.lower(), v) for k, v in (line.split(": ", 1) for line in head.decode().split("\r\n")[1:]))
    head, _, rest = plain.partition(b"\r\n\r\n")
    warc = fields(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http), payload


def package(folder: str, name: str, data: bytes, index: list[str], records: int) -> tuple[str, int, int]:
    """Write one package; its path, size and number of records."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for member, content in ((DATA, data), (INDEX, "".join(sorted(index)).encode())):
            z.writestr(zipfile.ZipInfo(member, (2024, 1, 1, 0, 0, 0)), content)
    attempt = f"{path}/.{name}-{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    with store.open_output_stream(attempt) as f:
        f.write(out.getbuffer())
    store.move(attempt, f"{path}/{name}")
    return f"{folder}/{name}", out.getbuffer().nbytes, records


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write (page_id, url, html) as packages; (path, bytes, records) of each, when an action runs."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))})
    long_enough = rows.where(F.octet_length("payload") >= least_bytes)
    first = long_enough.groupBy("digest").agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n")).where("n > 1")
    salted = first.select(F.col("digest").alias("d"), "first_page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("s"))
    told = rows.join(salted, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")), "left")
    revisit = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    told = told.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first_page")).alias("refers_to"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), []
        data, index = bytearray(), []
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                name = base64.b32encode(bytes.fromhex(digest)).decode()
                raw = record(page_id, url, payload, name, refers_to, refers_to is not None)
                place = {"url": url, "digest": f"sha1:{name}", "length": len(raw), "offset": len(data), "filename": DATA}
                index.append(f"{len(data):020d} {DATE} {json.dumps(place)}\n")
                data += raw
                if len(data) >= PACKAGE_BYTES:
                    made.append(package(folder, f"part-{part:06d}-{len(made):04d}.wacz", bytes(data), index, len(index)))
                    data, index = bytearray(), []
        if index:
            made.append(package(folder, f"part-{part:06d}-{len(made):04d}.wacz", bytes(data), index, len(index)))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], ["path", "bytes", "records"])

    return told.mapInArrow(pack, MANIFEST)


class Package:
    """The directory of a ZIP file, read from its end; members are byte ranges."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        self.size = self.file.size()
        self.members = {name: self._data(*entry) for name, *entry in self._entries()}

    def read(self, start: int, length: int) -> bytes:
        return self.file.read_at(length, start)

    def _entries(self) -> Iterator[tuple[str, int, int, int]]:
        """Name, method, stored size and place of the local header of each entry of the central directory."""
        # The end record is 22 bytes and a comment of up to 65,535.
        tail_at = max(0, self.size - 65_557)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end of a central directory: not a ZIP file")
        count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
        if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            locator = self.read(tail_at + at - 20, 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            end = self.read(struct.unpack("<Q", locator[8:16])[0], 56)
            if end[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of the central directory")
            count, length, start = struct.unpack("<QQQ", end[32:56])
        directory, at = self.read(start, length), 0
        for _ in range(count):
            if directory[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken entry in the central directory")
            method, = struct.unpack("<H", directory[at + 10 : at + 12])
            stored, size, n_name, n_extra, n_comment = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
            header, = struct.unpack("<I", directory[at + 42 : at + 46])
            name = directory[at + 46 : at + 46 + n_name].decode()
            extra, e = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
            while e + 4 <= len(extra):
                kind, n = struct.unpack("<HH", extra[e : e + 4])
                if kind == 1:  # 64-bit values for those fields that are full, in this order
                    wide = iter(struct.unpack(f"<{n // 8}Q", extra[e + 4 : e + 4 + n // 8 * 8]))
                    size = next(wide) if size == 0xFFFFFFFF else size
                    stored = next(wide) if stored == 0xFFFFFFFF else stored
                    header = next(wide) if header == 0xFFFFFFFF else header
                e += 4 + n
            yield name, method, stored, header
            at += 46 + n_name + n_extra + n_comment

    def _data(self, method: int, stored: int, header: int) -> tuple[int, int]:
        """Range of a member's bytes; its local header says how long it is itself."""
        if method:
            raise ValueError("the member is compressed; only stored members can be read by ranges")
        local = self.read(header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("no local header where the directory says")
        n_name, n_extra = struct.unpack("<HH", local[26:30])
        return header + 30 + n_name + n_extra, stored

    def ranges(self) -> Iterator[tuple[int, int]]:
        """Offset and length of each record in the index, in the order of places."""
        start, length = self.members[INDEX]
        places = (json.loads(line.split(b" ", 2)[2]) for line in self.read(start, length).splitlines())
        yield from sorted((p["offset"], p["length"]) for p in places)

    def records(self) -> Iterator[tuple[int, int, bytes]]:
        """Offset, length and bytes of each record; ranges that touch are read together."""
        data, _ = self.members[DATA]
        waiting: list[tuple[int, int]] = []

        def read_waiting() -> Iterator[tuple[int, int, bytes]]:
            low = waiting[0][0]
            raw = self.read(data + low, sum(waiting[-1]) - low)
            for offset, length in waiting:
                yield offset, length, raw[offset - low : offset - low + length]

        for offset, length in self.ranges():
            if waiting and (offset != sum(waiting[-1]) or offset + length - waiting[0][0] > READ_BYTES):
                yield from read_waiting()
                waiting = []
            waiting.append((offset, length))
        if waiting:
            yield from read_waiting()


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the packages at ``path``; payload is NULL for revisits, or if not asked for.

    The payload of a response is checked against its digest and length.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for offset, length, raw in Package(path).records():
                    head, http, payload = parse(raw)
                    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
                    kind = head["warc-type"]
                    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"broken payload at {offset} in {path}")
                    body = payload if payloads and kind == "response" else None
                    rows.append((page_of(head["warc-record-id"]), head.get("warc-target-uri"), kind, body, size, digest, page_of(head.get("warc-refers-to")), path, offset, length))
                    held += len(body or b"") + 200
                    if held >= READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return manifest.select("path").mapInArrow(look, RECORDS)


def round_trip(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write the pages, then read the packages back, one task for each few packages."""
    spark: SparkSession = pages.sparkSession
    write(pages, f"{folder}/packages", least_bytes).write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return read(manifest.repartition(max(1, manifest.count()), "path"), payloads=False)
