"""License scans by diagonal voting of word k-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from orrery.llm import words as T
from orrery.llm.license_texts import NOTICES, PHRASES

K = 3  # words of a gram: the shortest phrase
COVER = 0.7  # share of a notice's grams that must be there
STRETCH = 1.5  # within a window of so many times the notice's length
SMALL = 100_000  # grams of templates that are broadcast; more are joined by shuffle
DOCUMENT = 0  # the gram that stands for the document itself
KEY = ["doc_id", "text_hash", "n_words"]


class Template(NamedTuple):
    label: str
    words: list[str]
    exact: bool


def templates() -> list[Template]:
    """The phrases, then the notices."""
    return [Template(a, normal_words(b), True) for a, b in PHRASES] + [Template(a, normal_words(b), False) for a, b in NOTICES]


def normal_words(text: str) -> list[str]:
    w = T.words(pa.array([text]), T.NOT_ALNUM)
    return [bytes(w.data[s:e]).decode() for s, e in zip(w.start, w.end)]


def template_rows(given: Sequence[Template], k: int = K) -> list[tuple]:
    """`(template, label, exact, place, gram, grams, length)` for each gram of each template."""
    return [
        (i, t.label, t.exact, p, " ".join(t.words[p : p + k]), len(t.words) - k + 1, len(t.words))
        for i, t in enumerate(given)
        for p in range(len(t.words) - k + 1)
    ]


def _template_grams(spark: SparkSession, given: Sequence[Template], k: int) -> DataFrame:
    for t in given:
        if len(t.words) < k:
            raise ValueError(f"template of {t.label} has fewer than {k} words")
    rows = template_rows(given, k)
    w = T.words(pa.array([r[4] for r in rows]), T.NOT_ALNUM)
    keys = [int(T.grams(w.hash[a:b], k).view(np.int64)[0]) for a, b in zip(w.first, w.first[1:])]
    schema = "gram_hash long, template int, label string, exact boolean, place int, gram string, grams int, length int"
    all_ = [(h, *r) for h, r in zip(keys, rows)]
    out = spark.createDataFrame([(DOCUMENT, -1, None, True, 0, None, 1, 0), *all_], schema)
    return F.broadcast(out) if len(rows) <= SMALL else out.hint("merge")


def _rolling(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches, "text"):
            w = T.words(part.column("text"), T.NOT_ALNUM)
            n = w.counts()
            count = np.maximum(n - k + 1, 0)
            at = np.concatenate([[0], np.cumsum(count + 1)])
            hashes = np.full(at[-1], np.uint64(DOCUMENT))
            start, end = np.zeros(at[-1], np.int32), np.zeros(at[-1], np.int32)
            text_at = T.text_bytes(part.column("text"))[1]
            rolling = T.grams(w.hash, k)
            here = np.repeat(at[:-1], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            from_ = np.repeat(w.first[:-1], count) + (here - np.repeat(at[:-1], count))
            base = np.repeat(text_at[:-1], count)
            hashes[here] = rolling[from_]
            start[here] = w.start[from_] - base
            end[here] = w.end[from_ + k - 1] - base
            lists = [T.list_array(hashes, at)] + [
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x)) for x in (start, end)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text"), pa.array(n), *lists],
                ["doc_id", "text", "n_words", "hashes", "starts", "ends"],
            )

    return run


def license_places(docs: DataFrame, given: Sequence[Template] | None = None, k: int = K) -> DataFrame:
    """Places of license texts: `doc_id, text_hash, n_words, copies, template, label, exact, first, last, cover, found`.

    1. All rolling word `k`-grams of every document meet the template positions in a join on the gram's hash;
       the words of each hit are then compared, so a hash collision is no hit.
    2. Hits vote for their diagonal, the word's place less the template's. Neighbouring diagonals are one place: those that hits
       of one window can have, so words may be added, left out or moved inside it (a phrase: no others).
    3. A place is verified: a phrase needs all its grams, a notice `COVER` of them within a window of `STRETCH` times its length.
       `first` and `last` are those of the phrase or of the window that holds most grams, `cover` their share.

    Windows are swept, not tried: a hit counts for the starts from which it is inside and the first of its gram, so each hit is two
    events and the votes of all starts are their running sum. Empty texts and tables have no places; a long text is many rows.

    A document also hits the template -1 once, so each document has a row; `copies` counts equal rows
    `(doc_id, text)`, which are scanned as one. At most `SMALL` template grams are broadcast; more are
    joined by shuffle. Only hits are shuffled, no text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rolled = rows.mapInArrow(
        _rolling(k), "doc_id long, text string, n_words long, hashes array<long>, starts array<int>, ends array<int>"
    )
    grams = rolled.select("*", F.posexplode("hashes").alias("pos", "gram_hash"))
    start = F.get("starts", F.col("pos"))
    written_words = F.substring(F.col("text").cast("binary"), start + 1, F.get("ends", F.col("pos")) - start).cast("string")
    lowered = F.translate(written_words, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    same = F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ") == F.col("gram")
    hits = (
        grams.join(_template_grams(spark, given or templates(), k), "gram_hash")
        .where((F.col("template") < 0) | same)
        .select(
            "doc_id", F.xxhash64("text").alias("text_hash"), "n_words", "template", "label", "exact", "place", "grams", "length",
            F.when(F.col("template") < 0, 0).otherwise(F.col("pos")).alias("pos"),
        )
        .groupBy(*KEY, "template", "label", "exact", "place", "grams", "length", "pos")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("diagonal", F.col("pos") - F.col("place"))
    )
    window = F.floor(F.lit(STRETCH) * F.col("length")).cast("int")
    along = W.partitionBy(*KEY, "template").orderBy("diagonal", "pos")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("exact"), 0).otherwise(window - k + F.col("grams"))
    merged = hits.withColumn("new", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("at", F.sum("new").over(along))
    place = [*KEY, "template", "label", "exact", "grams", "length", "at"]
    phrases = merged.where("exact").groupBy(*place).agg(
        F.max("copies").alias("copies"),
        F.min("pos").cast("long").alias("first"),
        (F.max("pos") + k - 1).cast("long").alias("last"),
        F.size(F.collect_set("place")).cast("long").alias("votes"),
    )
    again = F.lag("pos").over(W.partitionBy(*place, "place").orderBy("pos"))
    event = lambda at, n: F.struct(at.alias("start"), F.lit(n).alias("n"))
    enters = F.greatest(again + 1, F.col("pos") - (window - k))
    events = (
        merged.where(~F.col("exact")).withColumn("e", F.array(event(enters, 1), event(F.col("pos") + 1, -1)))
        .select(*place, "copies", F.explode("e").alias("e")).groupBy(*place, "e.start").agg(F.sum("e.n").alias("n"), F.max("copies").alias("copies"))
    )
    swept = W.partitionBy(*place).orderBy("start")
    votes = events.select(*place, "copies", F.sum("n").over(swept).alias("votes"), (F.lead("start").over(swept) - 1).cast("long").alias("first"))
    notices = votes.groupBy(*place).agg(F.max("copies").alias("copies"), F.max(F.struct("votes", -F.col("first"))).alias("b")).select(
        *place, "copies", (-F.col("b.col2")).alias("first"), F.least(window - F.col("b.col2"), F.col("n_words")) - 1, F.col("b.votes").alias("votes")
    )
    enough = F.when(F.col("exact"), F.col("votes") == F.col("grams")).otherwise(F.col("votes") >= COVER * F.col("grams"))
    return phrases.select(*place, "copies", "first", "last", "votes").union(notices).select(
        *KEY, "copies", "template", "label", "exact", "first", "last", (F.col("votes") / F.col("grams")).alias("cover"), enough.alias("found")
    )


def license_labels(docs: DataFrame, given: Sequence[Template] | None = None) -> DataFrame:
    """One row per document: `doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`.

    Base columns count the phrases, `labels` adds the notices, `score` is the largest share of a template's
    grams at one place. A null text counts as empty; equal rows come back as often as they are given; a null
    `doc_id` stays null."""
    places = license_places(docs, given)
    real = F.col("template") >= 0
    base = real & F.col("exact") & F.col("found")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    out = places.groupBy(*KEY).agg(
        F.max(F.when(~real, F.col("copies"))).alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(real & F.col("found"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(real, F.col("cover"))), F.lit(0.0)).alias("score"),
    )
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
