"""Token counts by an exact histogram of encoded lengths."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.llm import words as T
from orrery.llm.segments import Memo, cut, read_file
from orrery.operators.ordered import BUCKET, running
from orrery.sources.storage import written

# Fixed value: how the byte-level vocabulary of 50,257 tokens splits text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 1024  # lengths of one part of the prefix sums
CHUNK = 4 << 20  # bytes of texts encoded at once, unless one text has more
# White space as that pattern knows it, in runs that its look-ahead cannot take.
RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
_COUNTERS: dict[tuple[str, str], Counter] = {}


class Counter:
    """Numbers of tokens of whole texts by a vocabulary of `base64 rank` lines.

    With the usual pattern, texts are cut into segments of which each distinct one is encoded once, and long runs of white
    space are merged without the pattern: all of a run, but for its last character where the text goes on, is one piece."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.own = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.cuts = pattern == PATTERN
        self.memo = Memo(self._learn, self._reset)
        self._reset()

    def _reset(self) -> None:
        self.sizes: list[int] = []

    def _learn(self, new: Sequence[bytes]) -> None:
        self.sizes += [self.count(x.decode()) for x in new]

    def count(self, text: str) -> int:
        total = at = 0
        for m in RUN.finditer(text) if self.cuts else ():
            end = m.end() - (m.end() < len(text))
            total += len(self.own.encode_ordinary(text[at : m.start()])) + len(self.own._encode_single_piece(text[m.start() : end]))
            at = end
        return total + len(self.own.encode_ordinary(text[at:]))

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if not self.cuts:
            return np.array([self.count(x) if x else 0 for x in texts.to_pylist()], np.int64)
        segments, counts = cut(texts, marks=True)
        numbers = self.memo.numbers(segments)
        sizes = np.array(self.sizes, np.int64)[numbers] if len(numbers) else np.zeros(0, np.int64)
        return np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])])


def encoded_lengths(docs: DataFrame, vocabulary: str, pattern: str = PATTERN, keep: Sequence[str] = ()) -> DataFrame:
    """The columns `keep` and `length`, the number of tokens of each whole `text`; a null text has none.

    Texts are encoded whole, segment by segment, however long they are; strings of special tokens are ordinary text. An
    empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(read_file(docs.sparkSession, vocabulary))
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (vocabulary, pattern) not in _COUNTERS:
            _COUNTERS[vocabulary, pattern] = Counter(shared.value, pattern)
        for part in T.slices(batches, "__text", CHUNK):
            sizes = _COUNTERS[vocabulary, pattern](part.column("__text"))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(sizes, pa.int64())], [*keep, "length"])

    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}{', ' if schema else ''}length long")


def length_histogram(docs: DataFrame, vocabulary: str, pattern: str = PATTERN) -> DataFrame:
    """`length, n_docs` for each encoded length that occurs, written. Documents are counted within each slice of texts first,
    so the shuffle sees at most a row per task and length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, n = np.unique(b.column("length").to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(n)], ["length", "n"])

    counted = encoded_lengths(docs, vocabulary, pattern).mapInArrow(count, "length long, n long")
    return written(counted.groupBy("length").agg(F.sum("n").alias("n_docs")), "lengths")


def context_table(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs, as a context limit: `length, n_docs, docs_over, tokens_over, truncated_tokens,
    dropped_tokens, rank`.

    `docs_over` and `tokens_over` are suffix sums over longer documents; texts cut to L tokens keep
    `truncated_tokens` and lose `dropped_tokens`; `rank` documents are at most L long. An empty histogram gives no rows.
    Sums run within blocks of lengths, then over block totals, so many lengths are no single task."""
    tokens = F.col("length") * F.col("n_docs")
    total = histogram.agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t")).first()
    marked = histogram.withColumn(BUCKET, F.floor(F.col("length") / BLOCK))
    sums = running(marked, ["length"], sums={"docs_from": F.col("n_docs"), "tokens_from": tokens}, descending=True)
    over, longer = F.col("docs_from") - F.col("n_docs"), F.col("tokens_from") - tokens
    dropped = longer - over * F.col("length")
    return sums.select(
        "length", "n_docs", over.alias("docs_over"), longer.alias("tokens_over"),
        (F.lit(total["t"] or 0) - dropped).alias("truncated_tokens"), dropped.alias("dropped_tokens"),
        (F.lit(total["d"] or 0) - over).alias("rank"),
    )


def truncated_totals(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """`limit, docs_over, truncated_tokens` for any limits, from the suffix sums of the shortest length above each: the documents
    from there on keep `limit` tokens, the shorter ones all."""
    limit = lambda x: F.lit(int(x)).cast("long")
    first = [F.min_by(F.struct("length", "n_docs", "docs_over", "tokens_over"), F.when(F.col("length") > limit(x), F.col("length"))) for x in limits]
    row = table.agg(F.max(F.col("truncated_tokens") + F.col("dropped_tokens")).alias("total"), F.array(*first).alias("f"))
    asked = row.select("total", F.posexplode("f").alias("at", "x"), F.array(*map(limit, limits)).alias("l"))
    over = F.coalesce(F.col("x.docs_over") + F.col("x.n_docs"), F.lit(0))
    longer = F.coalesce(F.col("x.tokens_over") + F.col("x.length") * F.col("x.n_docs"), F.lit(0))
    asked = asked.select(F.get("l", "at").alias("limit"), over.alias("docs_over"), longer.alias("longer"), "total").where("total IS NOT NULL")
    return asked.select("limit", "docs_over", (F.col("total") - F.col("longer") + F.col("docs_over") * F.col("limit")).alias("truncated_tokens")).distinct()


def length_quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """`share, length`: the smallest length that at least this share of the documents does not exceed."""
    total = table.agg(F.max("rank")).first()[0] or 0
    picks = [F.struct(F.lit(float(p)).alias("share"), F.min(F.when(F.col("rank") >= p * total, F.col("length"))).alias("length")) for p in shares]
    return table.agg(F.array(*picks).alias("x")).select(F.inline("x"))
