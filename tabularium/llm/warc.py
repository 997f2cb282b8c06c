"""WARC records in ZIP packages: writing, and reading by ranges without extraction.

A package holds stored (not deflated) members: archive/data.warc.gz, with one gzip member per record, and indexes/index.tsv,
with a line per record: offset and length in the archive member. A reader parses the end record, the ZIP64 end record where
there is one, and the central directory, finds the members' bytes, and fetches each record with one range read.

Packages are written and read through pyarrow file systems (local, S3, GCS, HDFS), below a folder that all executors share.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.batches import small_batches
from tabularium.llm.names import free_names, without
from tabularium.session import fresh_path, stored

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.tsv"
#: A package is closed beyond so many bytes.
PACKAGE_BYTES = 64 << 20
#: Crawled pages carry no date here; a record must have one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "key long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _urn(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def _key(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def make_record(key: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit whose HTTP head still tells the payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(key)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    block = http + payload if refers_to is None else http
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(["WARC/1.1", *head]).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of RECORD; a response's digest and length are those of its bytes, and must agree with its head."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != declared or base32_sha1(payload) != stated):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return {"key": _key(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": _key(fields.get("warc-refers-to")), "payload_bytes": declared, "payload_digest": stated,
            "payload": payload if kind == "response" else None}


class _Appender:
    """Only writes, so that the ZIP writer never seeks back."""

    def __init__(self, out: pa.NativeFile):
        self.write, self.flush = out.write, out.flush


class PackageWriter:
    """Streams records into one package."""

    def __init__(self, files: FileSystem, path: str):
        self.path, self.lines, self.size = path, [], 0
        self.out = files.open_output_stream(path)
        self.package = zipfile.ZipFile(_Appender(self.out), "w", zipfile.ZIP_STORED)
        self.member = self.package.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)

    def add(self, record: bytes) -> None:
        squeezer = zlib.compressobj(3, wbits=31)
        data = squeezer.compress(record) + squeezer.flush()
        self.member.write(data)
        self.lines.append(f"{self.size}\t{len(data)}\n")
        self.size += len(data)

    def close(self) -> dict:
        self.member.close()
        with self.package.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("".join(self.lines).encode())
        self.package.close()
        self.out.close()
        return {"path": self.path, "records": len(self.lines), "bytes": self.size}


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int


class PackageReader:
    """The central directory of a package, and range reads of its stored members."""

    TAIL = 65_557

    def __init__(self, source: pa.NativeFile):
        self.source, total = source, source.size()
        tail = source.read_at(min(total, self.TAIL), max(0, total - self.TAIL))
        at = tail.rfind(b"PK\5\6")
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
            at = tail.rfind(b"PK\5\6", 0, at)
        if at < 0:
            raise ValueError("no ZIP end record")
        count, size, start = struct.unpack("<HII", tail[at + 10:at + 20])
        if 0xFFFF in (count,) or 0xFFFFFFFF in (size, start):
            locator = source.read_at(20, total - len(tail) + at - 20)
            if locator[:4] != b"PK\6\7":
                raise ValueError("no ZIP64 locator")
            end = source.read_at(56, int.from_bytes(locator[8:16], "little"))
            if end[:4] != b"PK\6\6":
                raise ValueError("no ZIP64 end record")
            count, size, start = struct.unpack("<QQQ", end[32:56])
        self.members = dict(self._directory(source.read_at(size, start), count))

    @staticmethod
    def _directory(data: bytes, count: int) -> Iterator[tuple[str, Member]]:
        at = 0
        for _ in range(count):
            if data[at:at + 4] != b"PK\1\2":
                raise ValueError("damaged central directory")
            flags, method = struct.unpack("<HH", data[at + 8:at + 12])
            packed, size, names, extras, comment = struct.unpack("<IIHHH", data[at + 20:at + 34])
            header = int.from_bytes(data[at + 42:at + 46], "little")
            name = data[at + 46:at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
            extra, end = at + 46 + names, at + 46 + names + extras
            while extra + 4 <= end:
                kind, length = struct.unpack("<HH", data[extra:extra + 4])
                if kind == 1:  # 64-bit values stand here in this order, each only if its field above is full
                    values = [int.from_bytes(data[i:i + 8], "little") for i in range(extra + 4, extra + 4 + length - 7, 8)]
                    size = values.pop(0) if size == 0xFFFFFFFF else size
                    packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                    header = values.pop(0) if header == 0xFFFFFFFF else header
                extra += 4 + length
            yield name, Member(name, method, packed, header)
            at = end + comment

    def place(self, name: str) -> tuple[int, int]:
        """Offset and size of a stored member's bytes."""
        member = self.members[name]
        if member.method:
            raise ValueError(f"{name} is deflated; only stored members can be read by ranges")
        local = self.source.read_at(30, member.header)
        if local[:4] != b"PK\3\4":
            raise ValueError("damaged local header")
        return member.header + 30 + sum(struct.unpack("<HH", local[26:30])), member.size

    def records(self) -> Iterator[bytes]:
        """Every indexed record, each by a range read of its own."""
        archive, size = self.place(ARCHIVE)
        index = self.source.read_at(*self.place(INDEX)[::-1])
        for line in index.decode().splitlines():
            offset, length = map(int, line.split("\t"))
            if offset + length > size:
                raise ValueError("index points past its archive")
            yield zlib.decompress(self.source.read_at(length, archive + offset), wbits=31)


def with_revisits(pages: DataFrame, key: str, payload: str, least: int = 0) -> DataFrame:
    """pages with refers_to: of rows with equal payloads of at least that many bytes, the smallest key of the others.

    Null payloads count as empty. Rows that repeat the smallest key are responses as well. A null key refers to the smallest
    key that is not null, if there is one. Payloads are told apart by SHA-1, as WARC does.
    """
    kept = without(pages, ["refers_to"])
    digest, low, n = free_names(pages, "_digest", "_low", "_n")
    marked = pages.select(*kept, F.sha1(F.coalesce(payload, F.lit(b""))).alias(digest))
    shared = (marked.where(F.coalesce(F.octet_length(payload), F.lit(0)) >= least)
              .groupBy(digest).agg(F.min(key).alias(low), F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).drop(n))
    refers = F.when(~F.col(key).eqNullSafe(F.col(low)), F.col(low))
    return marked.join(shared, digest, "left").select(*kept, refers.alias("refers_to"))


def write_packages(pages: DataFrame, key: str, url: str, payload: str, folder: str | None = None) -> DataFrame:
    """Packages of the pages (with refers_to) below folder; returns (path, records, bytes), one row per package.

    Evaluated once. A task that is run again writes packages of new names, and only those of the attempt that counts are
    returned. An empty table gives no package. A null payload is an empty one.
    """
    small_batches(pages.sparkSession)
    folder = folder or fresh_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        writer, done = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                writer = writer or PackageWriter(files, f"{base}/{uuid.uuid4().hex}.wacz")
                writer.add(make_record(row[0], row[1], row[2] or b"", row[3]))
                if writer.size > PACKAGE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_pylist(done)

    rows = pages.select(F.col(key).cast("long"), url, payload, "refers_to")
    made = stored(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")
    return made.withColumn("folder", F.lit(folder))


def read_packages(packages: DataFrame) -> DataFrame:
    """Every record of the packages (path, folder), as RECORD; one task reads whole packages, a record at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for path, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_folder(folder)[0].open_input_file(path) as source:
                    rows, held = [], 0
                    for record in PackageReader(source).records():
                        rows.append(parse_record(record))
                        held += len(record)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return packages.select("path", "folder").repartition(F.col("path")).mapInArrow(read, RECORD)
