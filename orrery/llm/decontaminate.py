"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.llm import words as T
from orrery.sources.storage import written

K = 5  # words of a shingle
HASHES = 128
PIECE = 1 << 14  # shingles hashed at once
BITS = 24  # the filter of item shingles has 2 ** BITS bits (2 MB) whatever the number of items

_MULTIPLY = np.random.default_rng(21).integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(22).integers(0, 1 << 63, HASHES, dtype=np.uint64)


def size_class(n: int) -> int:
    """Items of 2 ** c to 2 ** (c + 1) - 1 shingles form partition c."""
    return int(n).bit_length() - 1


def _keys(minima: np.ndarray, part: int) -> np.ndarray:
    """Join keys of minima, a row per hash."""
    return T.mix(minima ^ _MULTIPLY[:, None]) + np.uint64(part)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in T.slices(batches, "text"):
        w = T.words(part.column("text"), T.SPACES)
        sets, at = T.distinct_sorted(*T.shingles(w, K))
        least = [(sets[a:b] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1, keepdims=True) for a, b in zip(at, at[1:]) if b > a]
        keys = [_keys(x, size_class(n)).ravel() for x, n in zip(least, np.diff(at)[np.diff(at) > 0])]
        ends = np.concatenate([[0], np.cumsum(np.where(np.diff(at) > 0, HASHES, 0))])
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [part.column("item_id"), pa.array(np.minimum(w.counts(), K)), pa.array(np.diff(at)), T.list_array(sets, at), T.list_array(flat, ends)],
            ["item_id", "length", "n_item", "shingles", "keys"],
        )


def _blocks(shingles: np.ndarray, hit: np.ndarray, classes: list[int]) -> list[np.ndarray]:
    """Keys of one text's blocks. For partition c the text is cut into cells of 2 ** (c + 1) shingles and two
    neighbouring cells are a block, so an item of that partition lies inside a block and is at least a fifth of it.
    Only minima that are shingles of some item can equal an item's, so blocks without any are left out."""
    out = []
    at = np.flatnonzero(hit)
    for part in classes:
        width = 2 << part
        last = (len(shingles) - 1) // width
        blocks = np.unique(np.concatenate([at // width, at // width - 1]))
        blocks = blocks[blocks >= 0]
        cells = np.unique(np.concatenate([blocks, np.minimum(blocks + 1, last)]))
        step = max(1, PIECE // width)
        pieces = [_minima(shingles, hit, cells[i : i + step], width) for i in range(0, len(cells), step)]
        least, found = (np.concatenate(x, axis=1) for x in zip(*pieces))
        own, after = np.searchsorted(cells, blocks), np.searchsorted(cells, np.minimum(blocks + 1, last))
        least = np.minimum(least[:, own], least[:, after])
        found = np.minimum(found[:, own], found[:, after])
        out.append(_keys(least, part)[least == found])
    return out


def _minima(shingles: np.ndarray, hit: np.ndarray, cells: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each hash (rows) and cell: the minimum over all shingles, and over those that are in the filter."""
    place = (cells[:, None] * width + np.arange(width)).ravel()
    place = place[place < len(shingles)]
    starts = np.searchsorted(place, cells * width)
    value = shingles[place] * _MULTIPLY[:, None] + _ADD[:, None]
    wanted = np.where(hit[place], value, np.uint64(0xFFFFFFFFFFFFFFFF))
    return np.minimum.reduceat(value, starts, axis=1), np.minimum.reduceat(wanted, starts, axis=1)


def _documents(bits, lengths: list[int], classes: list[int], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint64)
        mask = np.uint64((1 << BITS) - 1)

        def known(x: np.ndarray) -> np.ndarray:
            at = x & mask
            return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

        for part in T.slices(batches, "text"):
            w = T.words(part.column("text"), T.SPACES)
            counts = w.counts()
            rows: list[tuple[int, np.ndarray, np.ndarray]] = []
            by_length = []
            for k in lengths:
                all_ = T.grams(w.hash, k)
                hits = np.flatnonzero(known(all_))
                by_length.append((k, all_, hits))
            for i in _texts_with_hits(w, by_length):
                found, keys = [], []
                for k, all_, hits in by_length:
                    low, high = w.first[i], w.first[i + 1] - k + 1
                    here = hits[np.searchsorted(hits, low) : np.searchsorted(hits, max(high, low))]
                    if not len(here):
                        continue
                    hit = np.zeros(high - low, bool)
                    hit[here - low] = True
                    own = np.unique(all_[here])
                    found.append(own)
                    # An item of partition c needs so many of its 2 ** c or more shingles in the text.
                    able = [c for c in (classes if k == K else [0]) if 100 * len(own) >= percent << c]
                    keys += _blocks(all_[low:high], hit, able)
                if keys:
                    rows.append((i, np.unique(np.concatenate(found)), np.unique(np.concatenate(keys))))
            if rows:
                take = pa.array([r[0] for r in rows])
                ends = [np.concatenate([[0], np.cumsum([len(r[c]) for r in rows])]) for c in (1, 2)]
                lists = [T.list_array(np.concatenate([r[c] for r in rows]), e) for c, e in zip((1, 2), ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(take), part.column("text_hash").take(take), *lists], ["doc_id", "text_hash", "hits", "keys"]
                )

    return run


def _texts_with_hits(w: T.Words, by_length) -> np.ndarray:
    """Texts in which a hit starts; one that runs over a text's end is told apart later."""
    starts = np.concatenate([hits for _, _, hits in by_length]) if by_length else np.zeros(0, np.int64)
    return np.unique(np.searchsorted(w.first, starts, side="right") - 1)


def item_table(benchmark: DataFrame) -> DataFrame:
    """`item, item_id, length, n_item, shingles, keys` for each row of `benchmark (item_id, text)` with a word, written."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = rows.mapInArrow(_items, "item_id long, length long, n_item long, shingles array<long>, keys array<long>")
    return written(items.where("n_item > 0").withColumn("item", F.monotonically_increasing_id()), "items")


def contained_items(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """Items of which a document holds at least `percent` of the 5-word shingles: `doc_id, text_hash, item_id, n_item, n_shared,
    containment`, a row per document row and item row. An item with fewer words is one shingle, its whole sequence. Words
    are lower-cased (A-Z) runs without white space. Null and empty texts and items match nothing; equal rows each match.

    1. Items are partitioned by the size of their shingle set and keep their minima under `HASHES` universal hashes.
    2. A whole long document shares too little with a short item for MinHash, so documents are cut into overlapping blocks that fit each partition;
       the similarity to an item that a block contains to 75 percent is then at least 0.17, and all minima miss it once in 2e10, and an equal passage (0.25) once in 1e16.
    3. Equal minima make candidates; each is verified by exact containment in the whole document.

    A bit filter of fixed size over all item shingles goes to the tasks first; documents without any such shingle end
    there. It drops nothing that could match, and with very many items it merely lets more through. The shingles
    that pass are kept, so the exact check needs no second look at the texts, which are not shuffled."""
    spark = docs.sparkSession
    items = item_table(benchmark)
    places = items.select(F.explode("shingles").alias("s")).select(
        F.expr(f"shiftright(s & {(1 << BITS) - 1}L, 6)").cast("int").alias("w"), F.expr("shiftleft(1L, cast(s & 63L as int))").alias("b")
    )
    filled = places.groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow()  # at most 2 ** BITS / 64 rows
    table = np.zeros(1 << (BITS - 6), np.int64)
    table[filled.column("w").to_numpy()] = filled.column("b").to_numpy()
    shapes = items.select("length", F.expr("floor(log2(n_item))").cast("int").alias("part")).distinct().collect()  # under 5 * 40 rows
    lengths = sorted({r["length"] for r in shapes})
    classes = sorted({r["part"] for r in shapes})
    bits = spark.sparkContext.broadcast(table.tobytes())
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found = written(
        named.mapInArrow(_documents(bits, lengths, classes, percent), "doc_id long, text_hash long, hits array<long>, keys array<long>").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "blocks",
    )
    pairs = (
        found.select("row", F.explode("keys").alias("key"))
        .join(items.select("item", F.explode("keys").alias("key")), "key")
        .select("row", "item")
        .distinct()
    )
    both = pairs.join(found.select("row", "doc_id", "text_hash", "hits"), "row").join(
        items.select("item", "item_id", "n_item", "shingles"), "item"
    )
    shared = both.select(
        "doc_id", "text_hash", "item_id", "n_item", F.size(F.array_intersect("hits", "shingles")).cast("long").alias("n_shared")
    )
    return shared.where(100 * F.col("n_shared") >= percent * F.col("n_item")).withColumn("containment", F.col("n_shared") / F.col("n_item"))
