"""Web archives in ZIP packages: records written by Spark tasks, then read back by range.

A package holds, stored without compression, ``archive/data.warc.gz`` (one gzip member for each
record) and ``indexes/index.cdx`` (a line for each record: its id, place and length). Reading parses the end
record and the central directory, in ZIP64 form too, and fetches single records from inside
the stored archive; nothing is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import join_counted, table
from rosterlake.session import scratch, staged
from rosterlake.sources.stores import open_store

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_DATE = "1970-01-01T00:00:00Z"  # pages carry no date


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    number = name.strip().removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    """A response record with the payload, or a revisit that names the page holding it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"Content-Length: {len(body)}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(first)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    body = rest[: int(headers["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return headers, http, payload


class PackageWriter:
    """One package; bytes go out as they come, so only the index is held."""

    def __init__(self, uri: str):
        files, path = open_store(uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.lines, self.at = uri, [], 0
        self.sink = files.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, page_id: int | None, data: bytes) -> None:
        packed = gzip.compress(data, 1, mtime=0)
        self.data.write(packed)
        self.lines.append(json.dumps({"page": page_id, "offset": self.at, "length": len(packed)}))
        self.at += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        self.sink.close()
        return self.uri, len(self.lines)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # place of the local header


class PackageReader:
    """Directories of a package in any random-access file, and ranges of its stored members."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = {m.name: m for m in self._directory()}

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return bytes(self.file.read(n))

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 65_557 - 20)  # the longest comment, and the ZIP64 locator before the record
        tail = self._read(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        number, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
        if tail[end - 20 : end - 16] == b"PK\x06\x07":
            wide = self._read(struct.unpack("<Q", tail[end - 12 : end - 4])[0], 56)
            if wide[:4] != b"PK\x06\x06":
                raise ValueError("bad ZIP64 end record")
            number, length, start = struct.unpack("<QQQ", wide[32:56])
        directory, at = self._read(start, length), 0
        for _ in range(number):
            if directory[at : at + 4] != b"PK\x01\x02":
                raise ValueError("bad central directory")
            method, = struct.unpack("<H", directory[at + 10 : at + 12])
            packed, size, n_name, n_extra, n_comment = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
            header, = struct.unpack("<I", directory[at + 42 : at + 46])
            name = directory[at + 46 : at + 46 + n_name].decode("utf-8")
            extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
            while len(extra) >= 4:
                kind, n = struct.unpack("<HH", extra[:4])
                if kind == 1:  # wide values, in this order, of those that are full
                    values = list(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                    if size == 0xFFFFFFFF:
                        size = values.pop(0)
                    if packed == 0xFFFFFFFF:
                        packed = values.pop(0)
                    if header == 0xFFFFFFFF:
                        header = values.pop(0)
                extra = extra[4 + n :]
            yield Member(name, method, packed, header)
            at += 46 + n_name + n_extra + n_comment

    def start(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        member = self.members[name]
        if member.method:
            raise ValueError(f"{name} is compressed, not stored")
        local = self._read(member.header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("bad local header")
        return member.header + 30 + sum(struct.unpack("<HH", local[26:30]))

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        whole = self.members[name].size
        return self._read(self.start(name) + offset, whole - offset if length is None else length)

    def records(self, first: int = 0, last: int | None = None) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
        """Records by way of the index, from one number up to another, each read by its range."""
        base = self.start(DATA)
        for line in self.read(INDEX).decode().split("\n")[first:last]:
            if line:
                entry = json.loads(line)
                yield parse_record(zlib.decompress(self._read(base + entry["offset"], entry["length"]), 31))


def deduplicated(spark: SparkSession, pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages`` with ``first``, the least page_id with the same payload, where a payload of at least ``least_bytes``
    bytes occurs more than once. Pages move once; a payload that many pages share is split."""
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("key", F.sha1(F.col("html").cast("binary")))
    counted = keyed.filter(F.octet_length("html") >= least_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = staged(spark, counted.filter("n > 1"), "payloads")
    return join_counted(keyed, shared, "key", F.xxhash64("page_id", "url"), pages.count()).select(
        "page_id", "url", "html", "first", F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()).alias("revisit")
    )


def write_packages(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 0, package_bytes: int = 64 << 20) -> DataFrame:
    """Write a record for each page; returns (path, records) of the packages.

    A package is closed at ``package_bytes``. Names are new for each attempt of a task and only finished
    attempts report theirs, so packages of lost executors are never read. A null html is empty, a null url left out;
    of pages that repeat an id with one payload, all with the least id are responses.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(writer: PackageWriter) -> pa.RecordBatch:
            path, n = writer.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])

        writer = None
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, first, revisit = (batch.column(c)[i].as_py() for c in ("page_id", "url", "html", "first", "revisit"))
                writer = writer or PackageWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                writer.add(page_id, record(page_id, url, html.encode("utf-8"), first, revisit))
                if writer.at >= package_bytes:
                    yield done(writer)
                    writer = None
        if writer:
            yield done(writer)

    return staged(spark, deduplicated(spark, pages, least_bytes).mapInArrow(write, "path string, records long"), "packages")


def read_packages(packages: DataFrame, range_records: int = 1000, most_tasks: int = 10_000) -> DataFrame:
    """Every record of the packages (columns path and records): page_id, url, record_type, payload_digest, payload_bytes,
    refers_to, and the payload (null for a revisit). A response whose payload lacks its digest or length raises an error.

    Packages are read in ranges of at most ``range_records`` records, dealt to as many tasks as there are ranges, ``most_tasks`` at most: a
    large package, or few of them, keep all tasks busy. Each range reads the directory and the index, and of the archive only its own records.
    """
    n = packages.agg(F.sum(F.ceil(F.col("records") / range_records))).first()[0] or 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                files, place = open_store(path)
                with files.open_input_file(place) as file:
                    rows: list[tuple] = []
                    held = 0
                    for headers, http, payload in PackageReader(file, file.size()).records(begin, begin + range_records):
                        revisit = headers["warc-type"] == "revisit"
                        length = int(http.rpartition(b"Content-Length: ")[2])
                        hashed = headers["warc-payload-digest"].removeprefix("sha1:")
                        if not revisit and (len(payload), digest(payload)) != (length, hashed):
                            raise ValueError(f"damaged record in {path}")
                        refers = _page(headers["warc-refers-to"]) if revisit else None
                        rows.append((
                            _page(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], hashed, length, refers,
                            None if revisit else payload,
                        ))
                        held += len(payload)
                        if held > 1 << 23 or len(rows) == 4096:
                            yield _rows(rows)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows)

    ranges = packages.filter("records > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(range_records).cast("long"))).alias("first")
    )
    return ranges.repartition(int(min(n, most_tasks))).mapInArrow(read, _RECORD)


_RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [column.split()[0] for column in _RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)


def op5_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to packages and back. The packages go as soon as they were read."""
    with scratch(spark, "archives") as folder:
        packages = write_packages(spark, table(spark, sf_dir, "pages"), folder)
        found = read_packages(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        return staged(spark, found, "records")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(p.h, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - i % 4 * 5)) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN g USING (h)
"""
