"""Spelling variants: words that differ by one inserted, deleted or replaced character, by pairs of trie nodes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orrery.llm import words as T
from orrery.sources.storage import written

LETTERS = "A-Za-zÀ-ÿ"
LENGTH, COUNT = 5, 3  # code points and occurrences that a word has at least
CHUNK = 4 << 20  # bytes of text whose words are counted before the shuffle
PAIRS = 1 << 20  # node pairs made at once
FULL, REPEATED, FRESH = 0, 1, 2  # a split of the whole word; without a character that equals the one before it; without any other


# ---- words


def word_counts(docs: DataFrame, spoil: int = 0, length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """`word, n`: maximal runs of letters of all whole texts, A-Z lower-cased, with `length` code points and `count`
    occurrences at least. Words are counted per chunk of texts first, so a frequent word is one row per chunk in the shuffle.

    `spoil` plants misspellings: where it divides the unsigned crc32 h of `<doc_id>:<word>`, the word's code point
    h % length is deleted throughout the document. Null and empty texts have no words; a null doc_id is an empty one."""
    run_of = re.compile(f"[{LETTERS}]{{{length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches, "text", CHUNK):
            data, at = T.text_bytes(part.column("text"))
            whole = T.lower_ascii(data).tobytes()
            total: Counter[str] = Counter()
            for doc, low, high in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                text = whole[low:high].decode()
                found = Counter(run_of.findall(text) if len(text) <= CHUNK else (m.group() for m in run_of.finditer(text)))
                if not spoil:
                    total.update(found)
                    continue
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), before)
                    if h % spoil == 0:
                        place = h % len(word)
                        word = word[:place] + word[place + 1 :]
                        if len(word) < length:
                            continue
                    total[word] += n
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# ---- tries


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the trie nodes of sorted keys from 1, as if this part were all: a key's path shares the nodes of its common
    prefix with the key before it, and the rest are new."""
    part = TaskContext.get().partitionId()
    before, path, nodes, at = "", np.zeros(0, np.int64), 0, 0
    for batch in batches:
        for low in range(0, batch.num_rows, 1 << 12):
            rows = batch.slice(low, 1 << 12)
            paths = []
            for key in rows.column("key").to_pylist():
                shared = _common(before, key)
                path = np.concatenate([path[:shared], np.arange(nodes + 1, nodes + 1 + len(key) - shared)])
                nodes += len(key) - shared
                before = key
                paths.append(path)
            n = rows.num_rows
            ends = np.cumsum([0, *map(len, paths)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(paths)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part)), pa.array(np.arange(at, at + n)), rows.column("word"), rows.column("n"), rows.column("key"), listed],
                ["part", "at", "word", "n", "key", "path"],
            )
            at += n


def numbered_trie(words: DataFrame, reverse: bool = False) -> DataFrame:
    """`id, word, n, path`: the words, or the reversed words, numbered from 0 in code-point order, and the numbers of the trie nodes
    on each one's way from the root, which is 0 and left out.

    Sorted ranges are numbered on their own and written. A range shares nodes with earlier ones only along the common prefix of its
    first word and the last word before it, and those are its own first numbers. So one row per range (its end words, the last
    path, counts) goes to the driver, which hands back an offset and the shared path."""
    key = F.reverse("word") if reverse else F.col("word")
    schema = "part long, at long, word string, n long, key string, path array<long>"
    keyed = words.select("word", "n", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    local = written(keyed.mapInArrow(_paths, schema), "paths")
    ends = local.groupBy("part").agg(
        F.min_by("key", "at").alias("first"), F.max_by(F.struct("key", "path"), "at").alias("last"),
        F.count(F.lit(1)).alias("rows"), F.max(F.array_max("path")).alias("nodes"),
    )
    placed, rows, nodes, before, path = [], 0, 0, "", np.zeros(0, np.int64)
    for end in sorted(ends.collect(), key=lambda r: r["part"]):
        shared = _common(before, end["first"])
        placed.append((end["part"], rows, shared, nodes - shared, path[:shared].tolist()))
        own = np.array(end["last"]["path"], np.int64)
        given = np.concatenate([path[:shared], np.zeros(1, np.int64)])
        path = np.where(own <= shared, given[np.minimum(own, shared + 1) - 1], own + nodes - shared)
        before = end["last"]["key"]
        rows, nodes = rows + end["rows"], nodes + end["nodes"] - shared
    shifts = words.sparkSession.createDataFrame(placed, "part long, rows long, shared long, shift long, given array<long>")
    number = F.transform("path", lambda x: F.when(x <= F.col("shared"), F.get("given", (x - 1).cast("int"))).otherwise(x + F.col("shift")))
    return local.join(shifts, "part").select((F.col("at") + F.col("rows")).alias("id"), "word", "n", number.alias("path"))


# ---- node pairs


def _node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word all pairs (prefix node, suffix node) that split it, and those that leave out one character between."""
    for part in T.slices(batches, "word"):
        words = part.column("word").to_pylist()
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(size) - size
        fresh = np.ones(len(chars), bool)
        fresh[1:] = chars[1:] != chars[:-1]
        fresh[first] = True
        ends = [np.concatenate([[0], part.column(c).flatten().to_numpy()]) for c in ("forward", "backward")]
        made = 2 * size + 1
        begin = np.cumsum(made) - made
        ids, n = part.column("id").to_numpy(), part.column("n").to_numpy()

        def node(side: int, word: np.ndarray, depth: np.ndarray) -> np.ndarray:
            return np.where(depth > 0, ends[side][first[word] + depth], 0)

        for low in range(0, int(made.sum()), PAIRS):
            q = np.arange(low, min(low + PAIRS, int(made.sum())))
            word = np.searchsorted(begin, q, side="right") - 1
            place = q - begin[word]
            gap = place > size[word]
            place = np.where(gap, place - size[word] - 1, place)
            kind = np.full(len(q), FULL, np.int8)
            kind[gap] = np.where(fresh[first[word[gap]] + place[gap]], FRESH, REPEATED)
            cols = [node(0, word, place), node(1, word, size[word] - place - gap), ids[word], n[word], kind]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["prefix", "suffix", "id", "n", "kind"])


def near_words(words: DataFrame) -> DataFrame:
    """`id, word, n, n_near, best, best_n` for `words (word, n)` without repeats: how many other words differ from each by exactly one inserted,
    deleted or replaced code point, and the id and n of that with the largest n (ties: the smallest in code-point order).

    Words that leave the same pair of nodes around one character differ by a replacement; a word that the pair splits without a gap
    differs from them by a deletion. Deleting any of several equal neighbours gives one word, so only the first of them counts. A pair has
    one whole word and at most one gap word per letter, so its group is bounded by the alphabet."""
    forward = numbered_trie(words).withColumnRenamed("path", "forward")
    backward = numbered_trie(words, reverse=True).select("word", F.col("path").alias("backward"))
    named = written(forward.join(backward, "word"), "tries")
    pairs = named.mapInArrow(_node_pairs, "prefix long, suffix long, id long, n long, kind byte")
    member = F.struct((-F.col("n")).alias("less"), "id", "kind")
    groups = (
        pairs.groupBy("prefix", "suffix").agg(F.array_sort(F.collect_list(member)).alias("m")).where("size(m) > 1")
        .withColumn("fulls", F.size(F.filter("m", lambda x: x["kind"] == FULL)))
        .withColumn("fresh", F.size(F.filter("m", lambda x: x["kind"] == FRESH)))
    )
    near = lambda x: F.when(x["kind"] == FULL, F.col("fresh")).otherwise(
        F.size("m") - 1 - F.when(x["kind"] == REPEATED, F.col("fulls")).otherwise(0)
    )
    other = lambda x: F.get("m", F.when(F.get("m", F.lit(0))["id"] == x["id"], 1).otherwise(0))
    found = groups.select(F.explode(F.transform("m", lambda x: F.struct(x["id"].alias("id"), near(x).alias("near"), other(x).alias("o")))).alias("x"))
    best = found.groupBy("x.id").agg(F.sum("x.near").alias("n_near"), F.min(F.struct("x.o.less", "x.o.id")).alias("b"))
    got = written(best.select("id", "n_near", F.col("b.id").alias("best"), (-F.col("b.less")).alias("best_n")), "near")
    return named.select("id", "word", "n").join(got, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "best", "best_n"
    )


# ---- forms


def _followed(links: DataFrame) -> DataFrame:
    """`id, root` of `links (id, up)`: the last word on each one's way up, found by doubling the steps."""
    hops = written(links.select("id", F.col("up").alias("root")), "hops")
    while True:
        then = hops.select(F.col("id").alias("root"), F.col("root").alias("next"))
        hops = written(hops.join(then, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "hops")
        if not hops.where("moved").limit(1).count():
            return hops.select("id", "root")
        hops = hops.select("id", "root")


def spelling_forms(words: DataFrame, times: int = 2) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for `words (word, n)` without repeats.

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that n is at least `times` the word's own;
    `root` follows forms to the last. n grows along forms, so there are no rings and few steps. Without words there
    are no rows; words are compared by code points as they are."""
    rated = written(near_words(words), "rated")
    linked = rated.where(F.col("best_n") >= times * F.col("n")).select("id", F.col("best").alias("up"), F.col("best_n").alias("form_n"))
    names = rated.select(F.col("id").alias("x"), F.col("word").alias("name"))
    chains = (
        linked.join(_followed(linked), "id")
        .join(names, F.col("x") == F.col("up")).drop("x").withColumnRenamed("name", "form")
        .join(names, F.col("x") == F.col("root")).drop("x", "root").withColumnRenamed("name", "root")
    )
    return rated.join(chains, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, spoil: int = 0) -> DataFrame:
    """`spelling_forms` of the words of all whole texts."""
    return spelling_forms(written(word_counts(docs, spoil), "words"))
