"""Tokens of two tokenizers aligned by their bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orrery.llm import words as T
from orrery.llm.segments import MOST, Memo, Ragged, cut, encode_each, read_file, spread, tokenizer
from orrery.sources.storage import written

CHUNK = 4 << 20  # bytes of texts whose id pairs are counted together, unless one text has more
SPACE = "▁"  # stands for a space in pieces


def jump(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token of two tilings of the same bytes, numbered from 0 in order.

    Every token points to the token of the other side that overlaps it farthest to the right, and a B token that no A token
    passes to itself. Doubling the steps leads all to the last token of their component."""
    n = len(end_a)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    over = np.searchsorted(end_a, end_b)  # the A token that holds the last byte of each B token
    then = np.concatenate([n + np.searchsorted(end_b, end_a), np.where(end_a[over] > end_b, over, n + np.arange(len(end_b)))])
    while True:
        far = then[then]
        if np.array_equal(far, then):
            break
        then = far
    group = np.unique(then, return_inverse=True)[1]
    return group[:n], group[n:]


def byte_level() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 characters for themselves, the others
    in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Side:
    """The bytes of each id of one tokenizer."""

    def __init__(self, entries: Sequence[bytes]) -> None:
        self.bytes = pa.array(entries, pa.large_binary())
        self.size = np.fromiter(map(len, entries), np.int64, len(entries))

    def matches(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the bytes of each segment's ids are those of the segment."""
        first = np.concatenate([[0], np.cumsum(self.size[ids])])
        ends = first[np.concatenate([[0], np.cumsum(counts)])]
        ok = np.diff(ends) == size
        made = np.frombuffer(self.bytes.take(pa.array(ids)).buffers()[2] or b"", np.uint8)
        own = np.cumsum(size) - size
        if ok.all():
            same = made[: len(data)] == data
            return np.diff(np.concatenate([[0], np.cumsum(same)])[np.append(own, len(data))]) == size
        for i in np.flatnonzero(ok).tolist():
            ok[i] = np.array_equal(made[ends[i] : ends[i + 1]], data[own[i] : own[i] + size[i]])
        return ok


class Aligner:
    """Learns how each distinct segment of text is aligned: its tokens, groups and links.

    Both tokenizers see a space before the text. Where a piece could hold a space after another character, or either
    tokenizer changes its text, texts are not cut."""

    def __init__(self, a: bytes, b: bytes, most: int = MOST) -> None:
        import sentencepiece

        self.made, cuts = tokenizer(a, True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b)
        back = byte_level()
        vocabulary = {i: t for t, i in self.made.get_vocab(with_added_tokens=True).items()}
        entries = [bytes(back.get(c, 0x3F) for c in vocabulary.get(i, "")) for i in range(max(vocabulary, default=-1) + 1)]
        sp = self.pieces
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        own = [bytes([int(t[3:5], 16)]) if sp.is_byte(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(names)]
        self.a, self.b = Side(entries), Side(own)
        odd = "ﬁ  Ａ x "  # a ligature, a wide letter, spaces: normalisers change them
        kept = "".join(own[i].decode("latin-1") for i in sp.encode(odd)) == (" " + odd).encode().decode("latin-1")
        self.cuts = cuts and kept and not any(SPACE in t.lstrip(SPACE) for t in names)
        spelled = [f"{i}{end}" for n, ends in ((len(entries), ",|"), (len(own), ",;")) for end in ends for i in range(n)]
        self.spelled = pa.array([t.encode() for t in spelled], pa.large_binary())
        self.memo = Memo(self._learn, self._reset, most)
        self._reset()

    def _reset(self) -> None:
        self.links = Ragged(np.int64)  # A id << 32 | B id
        self.sums = Ragged(np.int64)  # tokens of A, of B, groups, whether the bytes agree
        self.strings: list[bytes] = []

    def _learn(self, segments: Sequence[bytes]) -> None:
        a, a_n = encode_each(self.made, [s.decode() for s in segments])
        found = self.pieces.encode([s[1:].decode() for s in segments], num_threads=1)
        b_n = np.fromiter(map(len, found), np.int64, len(found))
        b = np.fromiter(chain.from_iterable(found), np.uint32, int(b_n.sum()))
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        data = np.frombuffer(b"".join(segments), np.uint8)
        valid = self.a.matches(a, a_n, data, size) & self.b.matches(b, b_n, data, size)
        a, b = a[np.repeat(valid, a_n)].astype(np.int64), b[np.repeat(valid, b_n)].astype(np.int64)
        a_n, b_n, size = np.where(valid, a_n, 0), np.where(valid, b_n, 0), np.where(valid, size, 0)
        end_a, end_b, ends = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]), np.cumsum(size)
        in_a, in_b = jump(end_a, end_b)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (in_a, in_b))
        n_groups = np.diff(np.searchsorted(end_b[last_b], ends, side="right"), prepend=0)
        self._spell(a, b, in_a, in_b, last_a, last_b, a_n + b_n)
        borders = np.union1d(end_a, end_b)  # a link is a stretch without a border inside
        links = a[np.searchsorted(end_a, borders)] << 32 | b[np.searchsorted(end_b, borders)]
        self.links.add(links, np.diff(np.searchsorted(borders, ends, side="right"), prepend=0))
        self.sums.add(np.column_stack([a_n, b_n, n_groups, valid]).ravel(), np.full(len(segments), 4))

    def _spell(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, counts: np.ndarray) -> None:
        """`a1,a2|b1;` for each group of each segment."""
        groups = int(in_b[-1]) + 1 if len(in_b) else 0
        n_a, n_b = np.bincount(in_a, minlength=groups), np.bincount(in_b, minlength=groups)
        order = np.empty(len(a) + len(b), np.int64)
        size_a, size_b = len(self.a.size), len(self.b.size)
        order[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[in_a]] = a + np.where(last_a, size_a, 0)
        order[np.arange(len(b)) + np.cumsum(n_a)[in_b]] = b + 2 * size_a + np.where(last_b, size_b, 0)
        spelled = self.spelled.take(pa.array(order))
        whole = (spelled.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        at = np.frombuffer(spelled.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(counts)])].tolist() if len(order) else [0] * (len(counts) + 1)
        self.strings += [whole[low:high] for low, high in zip(at, at[1:])]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the segments of all texts, which come with a space in front, and how many each text has. A text
        with a segment whose bytes do not agree is tried as one segment."""
        if self.cuts:
            segments, counts = cut(texts)
        else:
            segments, counts = texts.filter(pa.compute.greater(pa.compute.binary_length(texts), 0)).cast(pa.large_binary()), None
            counts = (np.diff(T.text_bytes(texts)[1]) > 0).astype(np.int64)
        numbers = self.memo.numbers(segments)
        bad = ~self.valid()[numbers]
        if bad.any() and self.cuts:
            of = np.repeat(np.arange(len(counts)), counts)
            docs = np.unique(of[bad])
            whole = self.memo.numbers(texts.take(pa.array(docs)).cast(pa.large_binary()), keep=True)
            stay = ~np.isin(of, docs)
            all_ = np.concatenate([of[stay], docs])
            numbers = np.concatenate([numbers[stay], whole])[np.argsort(all_, kind="stable")]
            counts = np.bincount(all_, minlength=len(counts))
        return numbers, counts

    def valid(self) -> np.ndarray:
        return self.table()[:, 3] == 1

    def table(self) -> np.ndarray:
        return self.sums.flat[: 4 * self.sums.rows].reshape(-1, 4)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}
_DOC = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, segments binary"
_CHUNK = "sizes binary, links binary, codes array<long>, docs array<long>"


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(counts)])])


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value of 32-bit numbers for each count."""
    at = np.concatenate([[0], np.cumsum(4 * counts)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at), pa.py_buffer(values.astype(np.uint32))])


def _chunk_rows(own: Aligner, part: pa.RecordBatch, chunk: int) -> pa.RecordBatch:
    """A row per document. The first one also has what the chunk's documents share: the links of its distinct segments (how many
    each has, as places in `codes`), its distinct id pairs (`codes`) and how many documents hold each (`docs`)."""
    numbers, counts = own(part.column("text"))
    used, segment = np.unique(numbers, return_inverse=True)
    links, sizes = own.links.take(used)
    codes, pair = np.unique(links, return_inverse=True)
    n = part.num_rows
    of = np.repeat(np.arange(n), counts)
    once = np.unique(of * max(1, len(used)) + segment)
    first = np.cumsum(sizes) - sizes
    seen, times = spread(pair, first[once % max(1, len(used))], sizes[once % max(1, len(used))])
    held = np.unique(np.repeat(once // max(1, len(used)), times) * max(1, len(codes)) + seen) % max(1, len(codes))
    table = own.table()[numbers]
    sums = [_per_text(table[:, i], counts) for i in range(3)]
    at = np.concatenate([[0], np.cumsum(counts)]).tolist()
    listed = numbers.tolist()
    spelled = (b"".join([own.strings[k] for k in listed[low:high]])[:-1] for low, high in zip(at, at[1:]))
    hashes = [hashlib.sha256(x).hexdigest() if x else "" for x in spelled]
    alone = lambda values, kind: pa.array([values] + [None] * (n - 1), kind)
    columns = [
        pa.array(np.full(n, chunk)), part.column("doc_id"), *map(pa.array, sums), pa.array(_per_text(sizes[segment], counts)),
        pa.array(hashes, pa.string()), _binary(segment, counts),
        alone(sizes.astype(np.uint32).tobytes(), pa.binary()), alone(pair.astype(np.uint32).tobytes(), pa.binary()),
        alone(codes, pa.list_(pa.int64())), alone(np.bincount(held, minlength=len(codes)), pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in f"{_DOC}, {_CHUNK}".split(", ")])


def aligned_chunks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """The rows of `_chunk_rows` for chunks of `documents (doc_id, text)`, written."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((read_file(spark, a), read_file(spark, b)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (a, b) not in _ALIGNERS:
            _ALIGNERS[a, b] = Aligner(*files.value)
        base = TaskContext.get().partitionId() << 32
        for i, part in enumerate(T.slices(batches, "text", CHUNK)):
            yield _chunk_rows(_ALIGNERS[a, b], part, base + i)

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.when(text != "", F.concat(F.lit(" "), text)).otherwise("").alias("text"))
    return written(rows.mapInArrow(run, f"{_DOC}, {_CHUNK}"), "aligned")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """`code, n, best`: in how many documents each id pair (A id << 32 | B id) is linked, and whether no pair of its A id
    is linked in more. Documents are counted per chunk first."""
    pairs = chunks.where("codes IS NOT NULL").select(F.explode(F.arrays_zip("codes", "docs")).alias("p"))
    counts = written(pairs.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.docs").alias("n")), "pairs")
    owner = F.shiftright("code", 32).alias("a")
    most = counts.groupBy(owner).agg(F.max("n").alias("most"))
    return counts.withColumn("a", F.shiftright("code", 32)).join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _totals(key: tuple, rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """Add up the counts of each document's links over its segments."""
    n, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
    at = pairs.column("at").to_numpy()
    n[at], best[at] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
    shared = {c: next(x for x in rows.column(c).to_pylist() if x is not None) for c in ("sizes", "links")}
    sizes, links = (np.frombuffer(shared[c], np.uint32).astype(np.int64) for c in ("sizes", "links"))
    held = rows.column("segments").combine_chunks()
    data, ends = T.text_bytes(held.cast(pa.large_binary()))
    segment = np.frombuffer(data.tobytes(), np.uint32)
    counts = np.diff(ends) // 4
    sums = [_per_text(_per_text(x[links], sizes)[segment], counts) for x in (best, n)]
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*(rows.column(c) for c in kept), *map(pa.array, sums), rows.column("groups_sha256")], [*kept, "n_best", "count_sum", "groups_sha256"])


def aligned_tokens(docs: DataFrame, a: str, b: str) -> DataFrame:
    """How the tokens of two tokenizers meet in each whole text, a row per row of `documents (doc_id, text)`: `doc_id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256`.

    `a` is the file of a byte-level tokenizer, `b` that of a piece model. Groups are components of overlapping tokens, found by pointer
    jumping; a link is an A and a B token that overlap, a pair's count the number of rows that hold it linked anywhere in the table. Null and empty
    texts, and those whose bytes either tokenizer changes, have no tokens. Repeated rows count as often as they come; a null doc_id
    stays. Texts are worked on segment by segment, so a long one needs memory for its segment numbers only.

    1. Chunks of texts: distinct segments are aligned once, and each distinct id pair of a chunk is one row.
    2. Counts of pairs by code, so a pair that all documents hold is one row per chunk in the shuffle.
    3. Each chunk gets the counts of its own pairs back and adds them up per document."""
    chunks = aligned_chunks(docs, a, b)
    own = chunks.where("codes IS NOT NULL").select("chunk", F.posexplode("codes").alias("at", "code"))
    known = own.join(pair_counts(chunks), "code").select("chunk", "at", "n", "best")
    rows = chunks.select(F.col("chunk").alias("part"), *[c for c in chunks.columns if c not in ("chunk", "codes", "docs")])
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("part").cogroup(known.groupBy("chunk")).applyInArrow(_totals, schema)
