"""Mix sources to target weights: capped water-filling and seeded repetitions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orrery.operators.ordered import BUCKET, running
from orrery.sources.storage import written

EPOCHS = 3  # a document is repeated at most so often
SEED = 17
DIGITS = 3  # hex digits of the sampling order that part a source: 4096 parts, whatever its size
SALTS = 16


def key_of(source: Column) -> Column:
    """A key that is never null and keeps null apart from every string; null is last in its order."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def cyclic_weight(index: Column) -> Column:
    """1, 2, 3, repeating, for the index 1, 2, ... of a source in code point order."""
    return (index - 1) % 3 + 1


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    """`df` written in ranges of `order`, numbered in that order."""
    return written(df.repartitionByRange(*order).withColumn(BUCKET, F.spark_partition_id()), "ranges")


def source_targets(sized: DataFrame, weight=cyclic_weight, epochs: int = EPOCHS) -> DataFrame:
    """`key, source_size, weight, target` for each source of `sized (key, size)`.

    The target is the smaller of `epochs` times the source's size and `level * weight`, with one level for all so that the
    targets add up to all sizes. Clamping sources in the order of cap per weight and sharing what is left among
    the others ends at that level: it is the largest that any step of the clamping reaches. Both orders are prefix
    sums over ranges of sources, so many sources are no single task."""
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    indexed = running(_ranged(sources, "key"), ["key"], sums={"index": F.lit(1)}).drop(BUCKET)
    weighted = indexed.select("key", "source_size", weight(F.col("index")).alias("weight")).withColumn(
        "cap", epochs * F.col("source_size")
    ).withColumn("fill", F.col("cap") / F.col("weight"))
    placed = _ranged(weighted, "fill", "key")
    total = placed.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    filled = running(placed, ["fill", "key"], sums={"caps": F.col("cap"), "weights": F.col("weight")})
    level = (F.lit(total["t"] or 0) - (F.col("caps") - F.col("cap"))) / (F.lit(total["w"] or 0) - (F.col("weights") - F.col("weight")))
    top = filled.agg(F.max(level)).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(float(top or 0.0)) * F.col("weight"))
    return placed.select("key", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per row of `docs (doc_id, text, source)`: `doc_id, text_hash, size, source_size, target, repeats, taken`.

    A source takes each document as many whole times as its target holds its size; for the rest it takes documents once
    more in the seeded order of `md5(seed:doc_id)` until the target is met to half a document. Null texts have size 0, a null
    source is a source of its own, a null `doc_id` is ordered as an empty one, rows equal in `doc_id` and size are
    interchangeable. Reruns and other partitionings give the same rows. Texts are read once and not shuffled."""
    sized = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
            key_of(F.col("source").cast("string")).alias("key"),
            F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        ).withColumn("draw", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))),
        "sizes",
    )
    targets = source_targets(sized, epochs=epochs).withColumn(
        "whole", F.when(F.col("target") >= epochs * F.col("source_size"), F.lit(epochs)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    )
    salted = targets.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    placed = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).join(salted, ["key", "salt"])
    parted = placed.withColumn(BUCKET, F.conv(F.substring("draw", 1, DIGITS), 16, 10).cast("int"))
    summed = running(parted, ["draw", "doc_id", "size"], keys=["key"], sums={"upto": F.col("size")})
    need = F.col("target") - F.col("whole") * F.col("source_size")
    more = (2 * F.col("upto") - F.col("size") <= 2 * need) & (F.col("whole") < epochs)
    repeats = (F.col("whole") + more.cast("int")).cast("long")
    return summed.select(
        "doc_id", "text_hash", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken")
    )
