"""Token ids in binary files of compressed bit or byte planes: `spark.read.format("tokenplanes")`, `df.write.format("tokenplanes")`.

A file holds the ids of whole documents in order, as one stream cut into blocks of a fixed number of ids:

    magic, blocks, index, footer (two little-endian 64-bit numbers: where the index starts and how long it is), magic

A block of n ids is transposed into planes: bit plane k holds bit k of each id (eight ids a byte, low bit first), byte plane k
byte k of each. Planes above the block's largest id are left out. Each plane is a Zstandard frame of its own. The index
is a Zstandard frame of JSON (unit, ids of a block, number of blocks, documents and planes) and little-endian 64-bit arrays: per block
its place and number of planes, per plane its length, per document its id, whether that is null, and its number of ids.
The manifest of a folder lists the committed files in order with their numbers of ids, so the place of every document
in the whole stream is known, and readers seek to the blocks they need.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from orrery.llm import words as T
from orrery.llm.segments import Encoder, read_file
from orrery.sources.storage import work_folder

MAGIC = b"IDPLANE1"
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
MANIFEST = "_committed.json"
BLOCK = 1 << 16  # ids of a block
FILE_IDS, FILE_DOCS = 1 << 28, 1 << 20  # a file is closed beyond either
TASK_IDS = 1 << 25  # ids of a read task, unless one document has more
BATCH_IDS = 1 << 20  # ids of a batch, unless one document has more
LEVEL = 3
CHUNK = 4 << 20  # bytes of texts encoded at once, unless one text has more
REMEMBERED = 1 << 20  # distinct segments a worker remembers: 100 MB of prose in four languages have 830,000


# ---- planes


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of unsigned 32-bit ids, lowest first, without those that are zero above the largest id."""
    bits = int(ids.max()).bit_length() if len(ids) else 0
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(-(-bits // 8))]
    return [np.packbits((raw[:, k // 8] >> (k % 8)) & 1, bitorder="little").tobytes() for k in range(bits)]


def from_planes(planes: Sequence[bytes], n: int, unit: str) -> np.ndarray:
    """The `n` ids of a block."""
    raw = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        held = np.frombuffer(plane, np.uint8)
        if unit == "byte":
            raw[:, k] = held
        else:
            raw[:, k // 8] |= np.unpackbits(held, count=n, bitorder="little") << (k % 8)
    return raw.view("<u4").reshape(-1)


# ---- files


class FileWriter:
    """Writes one file; documents come in order, in any batches."""

    def __init__(self, stream: Any, unit: str, block: int, level: int) -> None:
        self.stream, self.unit, self.block = stream, unit, block
        self.squeeze = zstandard.ZstdCompressor(level=level)
        self.at = len(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.places: list[int] = []
        self.planes: list[int] = []
        self.lengths: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_ids = self.n_docs = 0
        stream.write(MAGIC)

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids, nulls, counts))
        self.n_docs += len(counts)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            self._flush(False)

    def _flush(self, all_: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        upto = len(ids) if all_ else len(ids) // self.block * self.block
        for low in range(0, upto, self.block):
            packed = [self.squeeze.compress(p) for p in to_planes(ids[low : min(low + self.block, upto)], self.unit)]
            self.places.append(self.at)
            self.planes.append(len(packed))
            for p in packed:
                self.stream.write(p)
                self.lengths.append(len(p))
                self.at += len(p)
        self.waiting, self.n_waiting = [ids[upto:].copy()], len(ids) - upto

    def close(self) -> int:
        """Write what is left and the index; the size of the file."""
        self._flush(True)
        head = json.dumps({"unit": self.unit, "block": self.block, "blocks": len(self.places), "planes": len(self.lengths), "docs": self.n_docs, "ids": self.n_ids})
        arrays = [self.places, self.planes, self.lengths, *(np.concatenate([d[i] for d in self.docs] or [np.zeros(0)]) for i in range(3))]
        index = self.squeeze.compress(struct.pack("<q", len(head)) + head.encode() + b"".join(np.asarray(a, "<i8").tobytes() for a in arrays))
        self.stream.write(index + struct.pack("<qq", self.at, len(index)) + MAGIC)
        self.stream.close()
        return self.at + len(index) + 16 + len(MAGIC)


class FileReader:
    """The index of a file, and its ids from any place on."""

    def __init__(self, stream: Any) -> None:
        self.stream = stream
        size = stream.size()
        foot = stream.read_at(16 + len(MAGIC), size - 16 - len(MAGIC)) if size >= 16 + 2 * len(MAGIC) else b""
        if foot[16:] != MAGIC:
            raise ValueError("no file of token planes, or one that was not closed")
        at, length = struct.unpack("<qq", foot[:16])
        self.unpack = zstandard.ZstdDecompressor()
        index = self.unpack.decompress(stream.read_at(length, at))
        n = struct.unpack("<q", index[:8])[0]
        self.head = json.loads(index[8 : 8 + n])
        sizes = [self.head[k] for k in ("blocks", "blocks", "planes", "docs", "docs", "docs")]
        self.places, self.planes, self.lengths, self.doc_ids, self.nulls, self.counts = np.split(
            np.frombuffer(index, "<i8", offset=8 + n), np.cumsum(sizes)[:-1]
        )
        self.first_plane = np.cumsum(self.planes) - self.planes
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def block(self, k: int) -> np.ndarray:
        lengths = self.lengths[self.first_plane[k] : self.first_plane[k] + self.planes[k]].tolist()
        raw = self.stream.read_at(sum(lengths), int(self.places[k]))
        n = min(self.head["block"], self.head["ids"] - k * self.head["block"])
        planes, at = [], 0
        for x in lengths:
            planes.append(self.unpack.decompress(raw[at : at + x]))
            at += x
        return from_planes(planes, n, self.head["unit"])

    def ids(self, low: int, high: int) -> np.ndarray:
        """The ids from place `low` up to `high`, from the blocks that hold them."""
        if low >= high:
            return np.zeros(0, np.uint32)
        size = self.head["block"]
        found = np.concatenate([self.block(k) for k in range(low // size, (high - 1) // size + 1)])
        return found[low - low // size * size :][: high - low]


# ---- data source


@dataclass
class _Written(WriterCommitMessage):
    part: int
    files: list[dict[str, Any]]


@dataclass
class _Piece(InputPartition):
    """The documents of a file that start from place `low` up to `high`; the file's first id is the stream's id `base`."""

    name: str
    base: int
    low: int
    high: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    source, base = fs.FileSystem.from_uri(path)
    return source, base.rstrip("/")


class PlanesWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own name in the order of its rows; the manifest of the commit lists those that
    count in the order of tasks, so that a lost or repeated attempt leaves nothing that is read."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.unit = options.get("unit", "byte")
        if self.unit not in ("bit", "byte"):
            raise ValueError(f"unit is bit or byte, not {self.unit}")
        self.block, self.level = int(options.get("block", BLOCK)), int(options.get("level", LEVEL))
        self.file_ids, self.file_docs = int(options.get("fileids", FILE_IDS)), int(options.get("filedocs", FILE_DOCS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        target, base = _opened(self.path)
        target.create_dir(base, recursive=True)
        done: list[dict[str, Any]] = []
        out, name = None, ""

        def close() -> None:
            size = out.close()
            done.append({"name": name, "ids": out.n_ids, "docs": out.n_docs, "bytes": size})

        for batch in iterator:
            for part in _bounded(batch):
                if out is None:
                    name = f"ids-{uuid.uuid4().hex}.planes"
                    out = FileWriter(target.open_output_stream(f"{base}/{name}", compression=None), self.unit, self.block, self.level)
                out.add(*part)
                if out.n_ids >= self.file_ids or out.n_docs >= self.file_docs:
                    close()
                    out = None
        if out is not None:
            close()
        return _Written(TaskContext.get().partitionId(), done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        target, base = _opened(self.path)
        target.create_dir(base, recursive=True)
        there = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        with target.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write(json.dumps([f for m in there for f in m.files]).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        target, base = _opened(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                target.delete_file(f"{base}/{f['name']}")


def _bounded(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, null marks, counts and ids of slices of a batch `(doc_id, ids)`."""
    for part in T.slices([batch.select(["doc_id", "ids"])], "ids", 4 * BATCH_IDS):
        data, at = T.text_bytes(part.column("ids").cast(pa.large_binary()).fill_null(b""))
        names = part.column("doc_id")
        yield names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False), np.diff(at) // 4, np.frombuffer(data.tobytes(), "<u4")


class PlanesReader(DataSourceReader):
    """Tasks of about `taskIds` ids each, whatever the size of the files. Without `ids` in the schema only indexes are read."""

    def __init__(self, schema: types.StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.task_ids = int(options.get("taskids", TASK_IDS))

    def partitions(self) -> Sequence[InputPartition]:
        source, base = _opened(self.path)
        with source.open_input_stream(f"{base}/{MANIFEST}") as f:
            listed = json.loads(f.read())
        out, start = [], 0
        for f in listed:
            out += [_Piece(f["name"], start, low, low + self.task_ids) for low in range(0, max(1, f["ids"]), self.task_ids)]
            start += f["ids"]
        return out or [_Piece("", 0, 0, 0)]

    def read(self, partition: _Piece) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        source, base = _opened(self.path)
        with source.open_input_file(f"{base}/{partition.name}") as stream:
            held = FileReader(stream)
            starts = held.first[:-1]
            low, high = np.searchsorted(starts, [partition.low, partition.high]).tolist()
            while low < high:
                upto = min(high, max(low + 1, int(np.searchsorted(held.first, starts[low] + BATCH_IDS, side="right")) - 1))
                yield self._batch(held, low, upto, partition.base)
                low = upto

    def _batch(self, held: FileReader, low: int, high: int, base: int) -> pa.RecordBatch:
        made = {
            "doc_id": lambda: pa.array(held.doc_ids[low:high], mask=held.nulls[low:high] != 0),
            "start": lambda: pa.array(held.first[low:high] + base),
            "n_tokens": lambda: pa.array(held.counts[low:high]),
            "ids": lambda: _binary(held.ids(int(held.first[low]), int(held.first[high])), held.counts[low:high]),
        }
        return pa.RecordBatch.from_arrays([made[c]() for c in self.schema.names], self.schema.names)


def _binary(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value for each document: its ids as little-endian unsigned 32-bit numbers."""
    at = np.concatenate([[0], np.cumsum(counts * 4)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(np.ascontiguousarray(ids, "<u4").tobytes())])


class PlanesSource(DataSource):
    """Options: `path`; writing `unit` (bit or byte), `block`, `level`, `fileIds`, `fileDocs`; reading `taskIds`."""

    @classmethod
    def name(cls) -> str:
        return "tokenplanes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: types.StructType) -> PlanesReader:
        return PlanesReader(schema, dict(self.options))

    def writer(self, schema: types.StructType, overwrite: bool) -> PlanesWriter:
        if overwrite:
            raise ValueError("write token files to a new folder, with mode append")
        return PlanesWriter(dict(self.options))


# ---- documents


def token_rows(docs: DataFrame, vocabulary: str, end: int = 0, specials_as_text: bool = False) -> DataFrame:
    """`doc_id, ids`: the ids of each whole `text` and then `end`, as little-endian unsigned 32-bit numbers, in the order and the
    partitions of `docs`. A null or empty text has the end id only."""
    shared = docs.sparkSession.sparkContext.broadcast(read_file(docs.sparkSession, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value, vocabulary, specials_as_text)
        for part in T.slices(batches, "text", CHUNK):
            ids, counts = encode(part.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _binary(ids, counts + 1)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(file: bytes, name: str, specials_as_text: bool) -> Encoder:
    """One per worker process, so that what it learned serves the next task."""
    if (name, specials_as_text) not in _ENCODERS:
        _ENCODERS[name, specials_as_text] = Encoder(file, specials_as_text, REMEMBERED)
    return _ENCODERS[name, specials_as_text]


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PlanesSource)


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end: int = 0, specials_as_text: bool = False, **options: str) -> None:
    """Write the ids of `documents (doc_id, text)` into the new `folder` in ascending order of doc_id.

    Texts are shuffled into ranges of doc_id once and encoded where they are written. Null ids come first; rows that share a doc_id
    follow by the hash of their text, and spread over ranges by it. No row makes a folder without files."""
    register(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    made = token_rows(placed, vocabulary, end, specials_as_text)
    made.write.format("tokenplanes").options(**options).mode("append").save(folder)


def token_round_trip(docs: DataFrame, vocabulary: str, end: int = 0, specials_as_text: bool = False, **options: str) -> DataFrame:
    """Write `docs` to files in the work folder and read them back: `doc_id, start, n_tokens, ids_crc32`, a row per row of `docs`.

    `start` counts the ids of all documents before it. Null and empty texts have the end id alone; very long texts are
    encoded segment by segment and may span many blocks; repeated rows are written as often as they come."""
    spark = docs.sparkSession
    folder = work_folder(spark, "tokens")
    write_tokens(docs, vocabulary, folder, end, specials_as_text, **options)
    back = spark.read.format("tokenplanes").load(folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
