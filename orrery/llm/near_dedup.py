"""Near-duplicate documents: many universal hash minima with banding, verified on signatures and on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.llm import groups, words as T
from orrery.llm.graph import components
from orrery.sources.storage import written

K = 5  # words of a shingle
ROWS, BANDS = 5, 32  # a pair with similarity 0.75 shares no band once in 6,000 times, one with 0.85 once in 2e8
SLACK = 0.12  # over three standard deviations of the share of equal minima at similarity 0.75
PART = 500  # rows of a bucket that are held at once

_MULTIPLY = np.random.default_rng(11).integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(12).integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64)


def minima(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash over each text's shingles, a row per text that has shingles."""
    starts = first[:-1][np.diff(first) > 0]
    out = np.empty((len(starts), len(_MULTIPLY)), np.uint64)
    if len(starts):
        for j, (a, b) in enumerate(zip(_MULTIPLY, _ADD)):
            out[:, j] = np.minimum.reduceat(shingles * a + b, starts)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band of `ROWS` minima."""
    keys = np.empty((len(least), BANDS), np.uint64)
    for j in range(BANDS):
        key = np.full(len(least), np.uint64(j + 1))
        for r in range(ROWS):
            key = T.mix(key ^ least[:, j * ROWS + r])
        keys[:, j] = key
    return keys


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in T.slices(batches, "text"):
        w = T.words(part.column("text"), T.SPACES)
        all_, first = T.shingles(w, K)
        keys = band_keys(minima(all_, first))
        sets, at = T.distinct_sorted(all_, first)
        size = np.diff(at)
        some = size > 0
        sums = np.zeros((2, len(size)), np.uint64)
        for i, x in enumerate((sets, T.mix(sets + np.uint64(1)))):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix(x))])
            sums[i] = total[at[1:]] - total[at[:-1]]
        bands = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(size), *(pa.array(x.view(np.int64)) for x in sums), T.list_array(keys.ravel(), bands)],
            ["doc_id", "n_shingles", "f1", "f2", "bands"],
        )


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in T.slices(batches, "text"):
        least = minima(*T.shingles(T.words(part.column("text"), T.SPACES), K))
        raw = (least & np.uint64(0xFFFF)).astype(np.uint16)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([x.tobytes() for x in raw], pa.binary()), part.column("text")], ["id", "signature", "text"]
        )


def _confirm(percent: int):
    """Keep pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches, "text_a"):
            for sub in T.slices([part], "text_b"):
                sides = [T.distinct_sorted(*T.shingles(T.words(sub.column(c), T.SPACES), K)) for c in ("text_a", "text_b")]
                (a, fa), (b, fb) = sides
                good = np.zeros(sub.num_rows, bool)
                for i in range(sub.num_rows):
                    x, y = a[fa[i] : fa[i + 1]], b[fb[i] : fb[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                yield sub.select(["a", "b"]).filter(pa.array(good))

    return run


def _compare(least: float, percent: int):
    """Within one part of a bucket, links that join its components: pairs of different components whose signatures agree in a share of at
    least `least` are compared on full sets. A pair whose components a link of this part has joined already is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups.in_order(batches, ["key", "i", "j"]):
            if group.num_rows < 2:
                continue
            ids, comp, side = (group.column(c).to_numpy() for c in ("id", "comp", "part"))
            signs = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(len(ids), -1)
            left, right = (np.flatnonzero(side == group.column(c)[0].as_py()) for c in "ij")
            near = []
            for x in left:
                other = right[comp[right] != comp[x]]
                close = other[(signs[other] == signs[x]).mean(axis=1) >= least]
                if len(close):
                    near.append((x, close))
            links = _confirmed(group, near, comp.copy(), percent) if near else []
            if links:
                a, b = (ids[list(y)] for y in zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def _confirmed(group: pa.Table, near: list[tuple[int, np.ndarray]], comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Of candidates `(row, rows)`, links that full sets confirm, one for each two components that they join."""
    used = np.unique(np.concatenate([np.append(other, x) for x, other in near]))
    texts = group.column("text").combine_chunks().take(pa.array(used))
    sets, at = T.distinct_sorted(*T.shingles(T.words(texts, T.SPACES), K))
    members = np.unique(sets, return_inverse=True)[1].reshape(-1)
    size, marked = np.diff(at), np.zeros(members.max(initial=-1) + 1, bool)
    spot = np.zeros(group.num_rows, np.int64)
    spot[used] = np.arange(len(used))
    out = []
    for x, other in near:
        p = spot[x]
        own = members[at[p] : at[p + 1]]
        marked[own] = True
        for y in other:
            if comp[x] == comp[y]:
                continue
            q = spot[y]
            both = int(np.count_nonzero(marked[members[at[q] : at[q + 1]]]))
            if 100 * both >= percent * (size[p] + size[q] - both):
                out.append((int(x), int(y)))
                comp[comp == comp[y]] = comp[x]
        marked[own] = False
    return out


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Components of documents with 100 * intersection >= `percent` * union of their sets of 5-word shingles.

    `docs` has `doc_id` (long) and `text`; other columns are ignored. One row per row of `docs`: `doc_id, n_shingles,
    component_id, kept`. Words are lower-cased (A-Z) runs without white space; fewer than five words are one shingle. An
    empty or null text has no shingles and is linked with nothing. A null `doc_id` stays by itself: its component is null and it is kept.
    Rows with equal `doc_id` count as one document: a link of one holds for all.

    1. Minima of 160 universal hashes per document, 32 band keys, a 128-bit fingerprint of the set.
    2. Buckets that hold more than one set. Copies of a set meet in every bucket and are one node, its smallest doc_id, before any pair is made.
    3. Each node and the bucket centre it shares most bands with: a link if the full sets confirm it. Components.
    4. Buckets that still span several components, in parts of bounded size: pairs across components only, by signature and
       then on full sets in the same task, until the part's components are joined. Components again.

    So no group is expanded into all its pairs, and a pair that shares a band is left out only if its documents are already
    connected or their signatures rule it out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    nodes = written(
        docs.mapInArrow(_nodes, "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"), "nodes"
    )
    named = nodes.where("doc_id IS NOT NULL AND n_shingles > 0")
    banded = named.select("doc_id", "f1", "f2", F.explode("bands").alias("key"))
    shared = written(
        banded.groupBy("key")
        .agg(F.min("doc_id").alias("centre"), F.min("f1").alias("low"), F.max("f1").alias("high"))
        .where("low <> high")
        .select("key", "centre"),
        "buckets",
    )
    members = written(
        banded.join(shared, "key").groupBy("key", "centre", "f1", "f2").agg(F.min("doc_id").alias("id")).select("key", "centre", "id"),
        "members",
    )
    texts = written(
        docs.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(
            _signatures, "id long, signature binary, text string"
        ),
        "texts",
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(
            _confirm(percent), "a long, b long"
        )

    best = (
        members.where("id <> centre")
        .groupBy("id", "centre")
        .agg(F.count(F.lit(1)).alias("votes"))
        .groupBy(F.col("id").alias("b"))
        .agg(F.max_by("centre", "votes").alias("a"))
    )
    state = written(components(written(confirmed(best.select("a", "b")), "first")), "components")

    placed = members.join(state.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp")
    )
    placed = written(placed, "placed")
    mixed = written(
        placed.groupBy("key")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low <> high")
        .select("key", F.ceil(F.col("n") / PART).cast("int").alias("parts")),
        "mixed",
    )
    parted = placed.join(mixed, "key").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    both = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", "id", "comp", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    near = (
        both.join(texts, "id")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(_compare(percent / 100 - SLACK, percent), "a long, b long")
    )
    known = state.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = written(components(written(known.unionByName(near), "all_links")), "final")

    # A class of copies is looked up by its fingerprint, its component by its smallest document.
    classes = (
        named.groupBy("f1", "f2", "n_shingles")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .join(final.select(F.col("node").alias("least"), "component"), "least", "left")
        .where("least <> most OR component IS NOT NULL")
        .select("f1", "f2", "n_shingles", F.coalesce("component", "least").alias("component_id"))
    )
    out = nodes.join(written(classes, "classes"), ["f1", "f2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
