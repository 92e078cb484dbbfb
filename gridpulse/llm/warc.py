"""WARC archives as a Spark data source: written in tasks, read by file partitions with predicates on type and headers.

Every record is a gzip member of its own. Its length stands in the extra field ``sl`` of the member's header, so a reader that
decides on the record's headers goes to the next member without unpacking the payload. Archives without that field are read too.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from gridpulse.llm.common import stored
from gridpulse.session import ship_package

FORMAT = "warc"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
FILE_BYTES = 64 << 20
PARTITION_BYTES = 32 << 20
HEAD_BYTES = 4096
MANIFEST = "_committed.json"
# Of the WARC 1.1 standard and of gzip.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"

ROWS = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _named(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


_PAGE = re.compile(r"<urn:page:(-?[0-9]+)>")


def _page(name: str | None) -> int | None:
    """The page a record is named after; null for the names that other archives give."""
    found = _PAGE.fullmatch(name or "")
    return int(found[1]) if found else None


def record(row: dict) -> bytes:
    """One record, not compressed: headers, block (HTTP head, and the payload unless it is a revisit), end."""
    payload = b"" if row["record_type"] == "revisit" else row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_named(row['page_id'])}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(payload)}",
    ]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_named(row['refers_to'])}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """``data`` as a gzip member that says its own length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush() + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = struct.pack("<H2sHI", 8, b"sl", 4, len(GZIP_HEAD) + 10 + len(body))
    return GZIP_HEAD + extra + body


def member_length(head: bytes) -> int | None:
    """The length in the extra field, if there is one."""
    if len(head) >= 20 and head[:2] == GZIP_HEAD[:2] and head[3] & 4 and head[12:14] == b"sl":
        return struct.unpack("<I", head[16:20])[0]
    return None


def parsed_headers(data: bytes) -> tuple[dict[str, str], int] | None:
    """The headers by lower-case name and where the block begins; None if they are not complete yet."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}, end + 4


class _Member:
    """A record being read, from a gzip member or plain: headers first, the rest only on demand."""

    def __init__(self, stream, start: int):
        self.stream, self.start = stream, start
        stream.seek(start)
        self.head = stream.read(HEAD_BYTES)
        self.plain = self.head[:2] != GZIP_HEAD[:2]
        self.length = member_length(self.head)
        self.unpacker = None if self.plain else zlib.decompressobj(31)
        self.data = self.head if self.plain else self.unpacker.decompress(self.head, HEAD_BYTES)
        while (found := parsed_headers(self.data)) is None and self._more(HEAD_BYTES):
            pass
        self.headers, self.block = found or ({}, 0)
        length = self.headers.get("content-length", "")
        self.end = self.block + (int(length) if length.isdigit() else 0)
        # Only blocks that say so begin with the head of an HTTP message.
        while self.is_http and b"\r\n\r\n" not in self.data[self.block:self.end] and len(self.data) < self.end and self._more(HEAD_BYTES):
            pass

    def _more(self, size: int) -> bool:
        if self.plain:
            raw = self.stream.read(size)
            self.data += raw
            return bool(raw)
        raw = self.unpacker.unconsumed_tail or self.stream.read(max(size, HEAD_BYTES))
        if self.unpacker.eof or not raw:
            return False
        self.data += self.unpacker.decompress(raw, size)
        return True

    @property
    def is_http(self) -> bool:
        return self.headers.get("content-type", "").lower().startswith("application/http")

    def http(self) -> tuple[dict[str, str], int]:
        """The headers of the message in the block and where its payload begins; a block of another kind is all payload."""
        found = parsed_headers(self.data[self.block:self.end]) if self.is_http else None
        return (found[0], self.block + found[1]) if found else ({}, self.block)

    def payload_bytes(self) -> int | None:
        """What the message says of its payload's length, also where the record leaves it out; without a message the block's."""
        length = self.http()[0].get("content-length", "") if self.is_http else str(self.end - self.block)
        return int(length) if length.isdigit() else None

    def payload(self) -> bytes:
        while len(self.data) < self.end and self._more(self.end - len(self.data)):
            pass
        return self.data[self.http()[1]:self.end]

    def after(self) -> int:
        """Where the next record begins."""
        if self.length:
            return self.start + self.length
        if self.plain:
            return self.start + self.end + 4 if self.headers else self.start + max(len(self.data), 1)
        while not self.unpacker.eof and self._more(1 << 20):
            self.data = b""
        return self.stream.tell() - len(self.unpacker.unused_data)


HEADER_OF = {"record_type": "warc-type", "payload_digest": "warc-payload-digest", "url": "warc-target-uri",
             "page_id": "warc-record-id", "refers_to": "warc-refers-to"}


def header_value(column: str, headers: dict[str, str]):
    """The column that a header carries."""
    raw = headers.get(HEADER_OF[column])
    if column in ("page_id", "refers_to"):
        return _page(raw)
    return raw.removeprefix("sha1:") if raw and column == "payload_digest" else raw


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, int], ...]


def _at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI. Hadoop's names of S3 stand for S3."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


class WarcReader(DataSourceReader):
    """Plans files into partitions by size; tests pushed predicates on the headers; unpacks payloads only if the schema has them."""

    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema, self.wanted = path, schema, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in HEADER_OF and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            elif not (column in self.wanted and isinstance(f, IsNotNull)):
                yield f

    def partitions(self) -> list[Files]:
        system, folder = _at(self.path)
        manifest = f"{folder}/{MANIFEST}"
        if system.get_file_info(manifest).type == fs.FileType.File:
            with system.open_input_stream(manifest) as stream:
                found = [tuple(f) for f in json.loads(stream.read())]
        else:
            listed = system.get_file_info(fs.FileSelector(folder, recursive=True))
            found = [(i.path[len(folder) + 1:], i.size) for i in listed if i.path.endswith((".warc.gz", ".warc"))]
        parts, held, size = [], [], 0
        for name, length in sorted(found):
            if held and size + length > PARTITION_BYTES:
                parts.append(Files(tuple(held)))
                held, size = [], 0
            held.append(name)
            size += length
        return [*parts, Files(tuple(held))]

    def rows(self, path: str, system: fs.FileSystem) -> Iterator[dict]:
        fields = set(self.schema.names)
        with system.open_input_file(path) as stream:
            at, end = 0, stream.size()
            while at < end:
                found = _Member(stream, at)
                row = {c: header_value(c, found.headers) for c in HEADER_OF}
                if row["record_type"] and all(row[c] in values for c, values in self.wanted.items()):
                    row["payload_bytes"] = found.payload_bytes()
                    row["payload"] = found.payload() if "payload" in fields and row["record_type"] != "revisit" else None
                    yield {c: row.get(c) for c in self.schema.names}
                at = found.after()

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, folder = _at(self.path)
        arrow, held, size = to_arrow_schema(self.schema), [], 0
        for name in partition.paths:
            for row in self.rows(f"{folder}/{name}", system):
                held.append(row)
                size += len(row.get("payload") or b"") + 100
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(held, arrow)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)


class WarcWriter(DataSourceArrowWriter):
    """A file, or several of limited size, per task. Only files named at commit are read, so repeated and lost attempts leave no records."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _at(self.path)
        system.create_dir(folder, recursive=True)
        files, stream, size = [], None, 0
        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if stream is None:
                        name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        stream = system.open_output_stream(f"{folder}/{name}", compression=None)
                    data = member(record(row))
                    stream.write(data)
                    size += len(data)
                    if size >= FILE_BYTES:
                        stream.close()
                        files.append((name, size))
                        stream = None
        if stream is not None:
            stream.close()
            files.append((name, size))
        return Written(tuple(files))

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _at(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}") as stream:
            stream.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = _at(self.path)
        for name, _ in (f for m in messages if m for f in m.files):
            system.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROWS

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with predicate pushdown for Python sources."""
    ship_package(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``ROWS`` of ``page_id, url, html``: of equal payloads of at least ``min_bytes``, that with the largest id is the response.

    The others revisit it and carry no payload. Null html is an empty payload. Rows that share id and payload are all responses; null ids
    lose to others, and are responses where they are alone. Payloads are compared by SHA-1, as the format does. An empty table gives no
    records; a payload of any length is one record; columns beside these three play no part.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select("page_id", "url", F.encode(payload, "UTF-8").alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                         F.sha1(payload).alias("hex"))
    # kept by itself, so that the join can split a payload with very many copies over tasks
    first = stored(known.filter(F.col("payload_bytes") >= min_bytes).groupBy("hex").agg(F.max("page_id").alias("top")), "payloads")
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return known.join(first, "hex", "left").select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes", base32(F.col("hex")).alias("payload_digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("top")).alias("refers_to"))


def base32(hex_digest):
    """Base32 of a hex string of 40 digits: every five digits are four letters."""
    letters = []
    for at in range(0, 40, 5):
        bits = F.conv(F.substring(hex_digest, at + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
            for shift in (15, 10, 5, 0)
        ]
    return F.concat(*letters)


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """One record per row of ``pages``, as an archive at ``path``."""
    register(pages.sparkSession)
    records(pages, min_bytes).write.format(FORMAT).mode("append").save(path)


def read(spark: SparkSession, path: str, columns: str = ROWS) -> DataFrame:
    """The records at ``path``. Without ``payload`` among the columns no payload is unpacked; equality and IN on type, digest, URL and ids
    are decided on the headers."""
    register(spark)
    return spark.read.format(FORMAT).schema(columns).load(path)


def checked(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: responses measured on their payloads, revisits by their headers."""
    full = read(spark, path).filter("record_type = 'response'")
    heads = read(spark, path, ROWS.replace("payload binary, ", "")).filter("record_type = 'revisit'")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return full.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", base32(F.sha1("payload"))).select(*columns).unionByName(heads.select(*columns))
