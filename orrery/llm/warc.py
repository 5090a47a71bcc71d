"""WARC archives as a Spark data source: `spark.read.format("warc").load(folder)` and `df.write.format("warc")`."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from io import BufferedReader
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from orrery.sources.storage import work_folder, written

# The payload is empty in a revisit; its length and digest are those of the full payload in either case.
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary"
)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 1 << 30  # a file is closed beyond this size
TASK_BYTES = 128 << 20  # files are packed into read tasks up to this size
READ_ROWS = 2048
READ_BYTES = 8 << 20  # payload bytes of a batch, unless one record is larger
MANIFEST = "_committed-"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, as Arrow knows it (local, HDFS, object stores)."""
    return fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records


def _member(data: bytes, level: int = 6) -> bytes:
    """One gzip member with the skip-length field that the format's annex describes: compressed and full length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    total = 10 + 2 + 4 + 8 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return b"".join(
        [b"\x1f\x8b\x08\x04\0\0\0\0\0\xff", struct.pack("<H", len(extra)), extra, body, struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)]
    )


def _one_line(value: str) -> str:
    return "".join(c if c not in "\r\n\0" else " " for c in value).strip()


def _record(row: dict[str, Any], date: str) -> bytes:
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: {row['content_type'] or 'text/html; charset=utf-8'}\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{_one_line(row['record_id'])}>", f"WARC-Date: {row['date'] or date}"]
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {_one_line(row['target_uri'])}")
    head.append(f"WARC-Payload-Digest: sha1:{row['payload_digest']}")
    if revisit:
        head += [f"WARC-Refers-To: <{_one_line(row['refers_to'])}>", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Members:
    """Walk over the gzip members of a file: inflate the start of each, and the rest only if asked to."""

    def __init__(self, stream: Any):
        self.stream, self.at, self.size = stream, 0, stream.size()

    def __iter__(self) -> Iterator[_Members]:
        while self.at < self.size:
            head = self._read(self.at, 1 << 12)
            if head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != b"sl":
                raise ValueError(f"no skip length in the gzip member at byte {self.at}")
            extra = struct.unpack("<H", head[10:12])[0]
            self.length, self.full = struct.unpack("<II", head[16:24])
            self.start, self.body, self._first = self.at, self.at + 12 + extra, head[12 + extra :]
            self.at += self.length
            yield self

    def _read(self, at: int, n: int) -> bytes:
        return self.stream.read_at(min(n, self.size - at), at)

    def front(self) -> bytes:
        """Up to the end of the WARC and HTTP headers; 4 KB of the member nearly always hold them."""
        inflate, n = zlib.decompressobj(-15), 1 << 12
        data = inflate.decompress(self._first[: self.length], 1 << 14)
        while data.count(b"\r\n\r\n") < 2 and not inflate.eof and len(data) < self.full:
            n *= 4
            inflate = zlib.decompressobj(-15)
            data = inflate.decompress(self._read(self.body, min(n, self.length)), n)
            if n > 4 * self.length + (1 << 16) and len(data) >= self.full:
                break
        return data

    def whole(self) -> bytes:
        raw = self._read(self.start, self.length)
        data = zlib.decompress(raw[self.body - self.start : -8], -15)
        if struct.unpack("<I", raw[-8:-4])[0] != zlib.crc32(data):
            raise ValueError(f"damaged gzip member at byte {self.start}")
        return data


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.lower()] = value.strip()
    return out


def _parsed(front: bytes) -> dict[str, Any]:
    warc, _, rest = front.partition(b"\r\n\r\n")
    http, _, _ = rest.partition(b"\r\n\r\n")
    h, w = _headers(warc), _headers(http)
    bare = lambda x: None if x is None else x.removeprefix("<").removesuffix(">")
    length = w.get("content-length")
    return {
        "record_id": bare(h.get("warc-record-id")), "record_type": h.get("warc-type"), "target_uri": h.get("warc-target-uri"),
        "date": h.get("warc-date"), "content_type": w.get("content-type"),
        "payload_digest": (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "payload_bytes": None if length is None else int(length), "refers_to": bare(h.get("warc-refers-to")),
    }


# ---- data source

_TESTS = {
    EqualTo: lambda a, b: a is not None and b is not None and a == b,
    EqualNullSafe: lambda a, b: a == b,
    GreaterThan: lambda a, b: a is not None and a > b,
    GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b,
    LessThanOrEqual: lambda a, b: a is not None and a <= b,
    In: lambda a, b: a is not None and a in b,
    StringStartsWith: lambda a, b: a is not None and a.startswith(b),
    StringEndsWith: lambda a, b: a is not None and a.endswith(b),
    StringContains: lambda a, b: a is not None and b in a,
    IsNull: lambda a, _: a is None,
    IsNotNull: lambda a, _: a is not None,
}


@dataclass
class _Test:
    column: str
    kind: type
    value: Any

    def __call__(self, row: dict[str, Any]) -> bool:
        return _TESTS[self.kind](row[self.column], self.value)


class WarcReader(DataSourceReader):
    """One task per pack of files. Filters on header columns are decided on the parsed headers; only records that pass are
    inflated further, and only if the schema has `payload` or the option `verify` asks to check digests."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.verify = options.get("verify", "false").lower() == "true"
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.tests: list[_Test] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ("payload",))[0]
            if type(f) in _TESTS and column != "payload" and len(f.attribute) == 1:
                self.tests.append(_Test(column, type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        packs: list[list[str]] = []
        room = 0
        for name, size in sorted(files(self.path), key=lambda x: -x[1]):
            if not packs or size > room:
                packs.append([])
                room = self.task_bytes
            packs[-1].append(name)
            room -= size
        return [InputPartition(p) for p in packs] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        names = self.schema.names
        form = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in self.schema.fields])
        decode = "payload" in names or self.verify
        source, base = open_fs(self.path)
        rows: list[dict[str, Any]] = []
        held = 0
        for name in partition.value:
            with source.open_input_file(f"{base.rstrip('/')}/{name}") as stream:
                for member in _Members(stream):
                    row = _parsed(member.front())
                    if not all(t(row) for t in self.tests):
                        continue
                    if decode:
                        row["payload"] = self._payload(member, row)
                        held += len(row["payload"])
                    if "payload" not in names:
                        row.pop("payload", None)
                    rows.append(row)
                    if len(rows) >= READ_ROWS or held >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, form)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, form)

    def _payload(self, member: _Members, row: dict[str, Any]) -> bytes:
        if row["record_type"] == "revisit":
            return b""
        payload = member.whole().split(b"\r\n\r\n", 2)[2][:-4]
        if self.verify and (len(payload) != row["payload_bytes"] or digest(payload) != row["payload_digest"]):
            raise ValueError(f"payload of {row['record_id']} does not match its headers")
        return payload


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own name; a manifest written at the commit lists those that count, so a
    lost or repeated attempt leaves nothing that is read."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        target, base = open_fs(self.path)
        target.create_dir(base, recursive=True)
        done: list[tuple[str, int]] = []
        stream, name, size = None, "", 0
        try:
            for batch in iterator:
                for at in range(batch.num_rows):
                    if stream is None:
                        name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        stream = target.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None)
                    member = _member(_record(batch.slice(at, 1).to_pylist()[0], self.date))
                    stream.write(member)
                    size += len(member)
                    if size >= self.file_bytes:
                        stream.close()
                        done.append((name, size))
                        stream = None
        finally:
            if stream is not None:
                stream.close()
                done.append((name, size))
        return _Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        target, base = open_fs(self.path)
        target.create_dir(base, recursive=True)
        listed = [f for m in messages if m is not None for f in m.files]
        with target.open_output_stream(f"{base.rstrip('/')}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        target, base = open_fs(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else []:
                target.delete_file(f"{base.rstrip('/')}/{name}")


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


def files(path: str) -> list[tuple[str, int]]:
    """Committed files of a folder with their sizes; without any manifest all `.warc.gz` files count."""
    source, base = open_fs(path)
    there = source.get_file_info(fs.FileSelector(base))
    manifests = [i.path for i in there if i.base_name.startswith(MANIFEST)]
    if not manifests:
        return [(i.base_name, i.size) for i in there if i.base_name.endswith(".warc.gz")]
    out = []
    for m in manifests:
        with source.open_input_stream(m) as f:
            out += [tuple(x) for x in json.loads(f.read())]
    return out


def _arrow(kind: T.DataType) -> pa.DataType:
    return {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[kind.simpleString()]


class WarcSource(DataSource):
    """Options: `path`; reading `verify`, `taskBytes`; writing `date`, `fileBytes`. A schema with fewer of the columns
    reads less: without `payload` no payload is inflated."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("write archives to a new folder, with mode append")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark push filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# ---- archives of pages


def base32_digest(payload: Column) -> Column:
    """`digest` as a column expression: five hex digits are four base32 digits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    number = lambda i: F.conv(F.substring("__hex", i * 5 + 1, 5), 16, 10).cast("int")
    digit = lambda n, s: F.substring(F.lit(letters), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1))
    parts = [digit(number(i), s) for i in range(8) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def archive_rows(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The rows of `SCHEMA` for `pages (page_id, url, html)`.

    Of pages with equal payloads of at least `min_bytes` bytes, that with the largest page_id is the response and the
    others revisit it; smaller ones are all responses. A null html is an empty payload, a null page_id sorts before all others and, with equal payloads, is a revisit unless all are null.
    Equal rows of the largest page_id are each a response. A payload that many pages share is one row per task in the
    grouping; in the join back adaptive execution splits it. Only digests with more than one page are joined."""
    hashed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumn("__hex", F.sha1("payload"))
    rows = hashed.withColumn("payload_digest", base32_digest(F.col("payload"))).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    ).drop("__hex")
    shared = written(
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND last IS NOT NULL")
        .drop("n"),
        "payloads",
    )
    joined = rows.join(shared, "payload_digest", "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")) & (F.col("payload_bytes") >= min_bytes)
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return joined.select(
        name(F.col("page_id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit(None).cast("string").alias("date"), F.lit("text/html; charset=utf-8").alias("content_type"),
        "payload_digest", "payload_bytes", F.when(again, name(F.col("last"))).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_number(record_id: Column) -> Column:
    """The page_id in a record's name; null for a page without one."""
    return F.substring_index(record_id, ":", -1).try_cast("long")


def write_pages(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per page into the new `folder`."""
    register(pages.sparkSession)
    archive_rows(pages, min_bytes).write.format("warc").option("date", date).mode("append").save(folder)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write `pages` to archives in the work folder and read them back, checking each payload against its digest:
    `page_id, payload_bytes, payload_digest, record_type, refers_to`."""
    spark = pages.sparkSession
    folder = work_folder(spark, "warc")
    write_pages(pages, folder, min_bytes)
    heads = SCHEMA.removesuffix(", payload binary")
    back = spark.read.format("warc").schema(heads).option("verify", "true").load(folder)
    return back.select(
        page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
    )
