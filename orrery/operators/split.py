"""Reproducible splits and folds that do not depend on how the data is laid out.

A split is a set of cut points in a total order of the rows: hash order, or the order of a
column. The cut points are found by counting, a handful of values per class, and the rows
are then marked by comparing with them. Class counts, shares and cut points are written tables, joined on
the class, so there may be as many classes as rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from orrery.functions.hashing import stable_hash, unit_hash
from orrery.operators.ordered import BUCKET, MOST_ROWS, bucket_by_sort, dense_index, running
from orrery.sources.storage import written

IN_PLAN = 32  # classes whose cut points become part of the expression; those of more classes are joined
PARTS = 1 << 14  # parts of a range that holds too many rows
CLASS = "__class"


def fast_split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Mark about `fraction` of the rows, without any job."""
    return df.withColumn(out, unit_hash(F.col(key), seed) < fraction)


def _class_of(by: str | None) -> Column:
    return F.lit("") if by is None else F.coalesce(F.col(by).cast("string"), F.lit(""))


def _classes(rows: DataFrame) -> DataFrame:
    """Rows, ends and first key of each class."""
    found = rows.groupBy(CLASS).agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.min("key").alias("first")
    )
    return written(found, "classes")


def _too_large(most: int) -> Column:
    return (F.col("n") > most) & (F.col("lo") < F.col("hi"))


def _narrowed(rows: DataFrame, spans: DataFrame, most: int) -> DataFrame:
    """Spans with too many rows cut into parts; the parts that hold a wanted rank become the new spans.

    Both ends are parts of their own, so a span always shrinks."""
    pos, lo, hi = F.col("pos"), F.col("lo"), F.col("hi")
    share = F.nanvl(F.coalesce(F.try_divide(pos / 2 - lo / 2, hi / 2 - lo / 2), F.lit(0.0)), F.lit(0.0))
    between = 1 + F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
    part = F.when(pos == lo, 0).when(pos == hi, PARTS + 1).otherwise(between)
    inside = rows.select(CLASS, "pos").join(spans.where(_too_large(most)), CLASS).where(pos.between(lo, hi))
    counts = inside.groupBy(CLASS, lo.alias("span"), part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("pos").alias("lo"),
        F.max("pos").alias("hi"),
        F.first("before").alias("start"),
        F.first("ranks").alias("all"),
    )
    earlier = W.partitionBy(CLASS, "span").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.col("start") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    held = F.filter("all", lambda r: (r > F.col("before")) & (r <= F.col("before") + F.col("n")))
    cut = placed.withColumn("ranks", held).where(F.size("ranks") > 0)
    return spans.where(~_too_large(most)).unionByName(cut.select(*spans.columns))


def _cuts(rows: DataFrame, order: Sequence[str], wanted: DataFrame, most: int) -> DataFrame:
    """Order values at the wanted ranks of each class: `__before`, how many ranks lie before the first row,
    and `__cuts`, the found values with the number of times their rank was wanted.

    `rows` has the class, a number `pos` that grows with the order, and the order columns; `wanted` has a class's
    rows, ends and `ranks` (1 is the first row). Ranges around the wanted ranks are counted and cut again until
    each holds at most `most` rows or one `pos`; only these are sorted, each on its own."""
    held = F.filter("ranks", lambda r: r >= 1)
    first = wanted.select(CLASS, "lo", "hi", "n", F.lit(0).cast("bigint").alias("before"), held.alias("ranks"))
    spans = written(first.where(F.size("ranks") > 0), "spans")
    while spans.where(_too_large(most)).head(1):
        spans = written(_narrowed(rows, spans, most), "spans")
    near = rows.join(spans, CLASS).where(F.col("pos").between(F.col("lo"), F.col("hi")))
    place = F.row_number().over(W.partitionBy(CLASS, "lo").orderBy(*order))
    rank = F.col("before") + F.col("__place")
    spots = near.withColumn("__place", place).where(F.array_contains("ranks", rank))
    cut = F.struct(
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)]).alias("cut"),
        F.size(F.filter("ranks", lambda r: r == rank)).alias("times"),
    )
    found = spots.groupBy(CLASS).agg(F.collect_list(cut).alias("__cuts"))  # a row per wanted rank of the class
    before = F.size(F.filter("ranks", lambda r: r < 1)).alias("__before")
    return written(wanted.select(CLASS, before).join(found, CLASS, "left"), "cuts")


def _after(order: Sequence[str], cut: Row) -> Column:
    """Whether a row comes after the cut in the order of its columns."""
    later, same = F.lit(False), F.lit(True)
    for name, value in zip(order, cut):
        later = later | (same & (F.col(name) > F.lit(value)))
        same = same & (F.col(name) == F.lit(value))
    return later


def _add_passed(df: DataFrame, by: str | None, order: Sequence[str], cuts: DataFrame, out: str) -> DataFrame:
    """Add how many cuts of its class a row comes after; null for a class without any entry."""

    def passed(found: Row) -> Column:
        steps = (F.when(_after(order, c["cut"]), c["times"]).otherwise(0) for c in found["__cuts"] or [])
        return sum(steps, F.lit(found["__before"]))

    few = cuts.limit(IN_PLAN + 1).collect()
    if len(few) <= IN_PLAN:
        number = F.lit(None).cast("int")
        for found in few:
            number = passed(found) if by is None else F.when(_class_of(by) == found[CLASS], passed(found)).otherwise(number)
        return df.withColumn(out, number)
    here = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])
    later = F.aggregate(
        F.coalesce("__cuts", F.array()), F.col("__before"), lambda n, c: n + F.when(here > c["cut"], c["times"]).otherwise(0)
    )
    keyed = df.withColumn(CLASS, _class_of(by)).join(cuts, CLASS, "left")
    return keyed.withColumn(out, later).select(*[c for c in df.columns if c != out], out)


def _hash_rows(df: DataFrame, key: str, seed: int, by: str | None) -> DataFrame:
    h = stable_hash(F.col(key), seed)
    return df.select(_class_of(by).alias(CLASS), h.alias("h"), F.col(key).alias("key"), h.cast("double").alias("pos"))


def _key_rows(df: DataFrame, order: str, by: str | None) -> DataFrame:
    key = F.col(order)
    return df.select(_class_of(by).alias(CLASS), key.alias("key"), key.cast("double").alias("pos"))


def split_sizes(classes: DataFrame, fraction: float) -> DataFrame:
    """Add `n_test` to a table of `__class` and `n`: ceil(fraction * n) in all; the training rows are shared out by
    largest remainder, ties to the first class. The classes are ranked in sorted ranges, never in one list."""
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if not total:
        return classes.withColumn("n_test", F.lit(0).cast("bigint"))
    train = total - math.ceil(total * fraction)
    quota = F.col("n").cast("double") * F.lit(float(train)) / F.lit(float(total))
    shared = classes.withColumn("__quota", quota).withColumn("__base", F.floor("__quota"))
    shared = shared.withColumn("__short", F.col("__base") - F.col("__quota"))
    ranged = bucket_by_sort(shared, ["__short", CLASS])
    left = train - ranged.agg(F.sum("__base").alias("n")).first()["n"]
    ranked = dense_index(ranged, ["__short", CLASS], "__rank", bucket=BUCKET)
    sizes = F.col("n") - F.col("__base") - (F.col("__rank") <= left).cast("int")
    return ranked.select(*classes.columns, sizes.alias("n_test"))


def exact_split(
    df: DataFrame,
    key: str,
    fraction: float = 0.2,
    seed: int = 42,
    by: str | None = None,
    out: str = "is_test",
    most: int = MOST_ROWS,
) -> DataFrame:
    """Mark exactly ceil(fraction * n) rows, and in proportion within each class of `by`.

    The rows that come first in hash order are taken, so the split follows from key and seed
    alone. `key` must be unique and not null. One task sorts at most about `most` rows of a class."""
    rows = _hash_rows(df, key, seed, by)
    sizes = split_sizes(_classes(rows), fraction)
    cuts = _cuts(rows, ["h", "key"], sizes.withColumn("ranks", F.array("n_test")), most)
    hashed = df.withColumn("__h", stable_hash(F.col(key), seed))  # once per row, for all comparisons
    marked = _add_passed(hashed, by, ["__h", key], cuts, "__passed")
    return marked.withColumn(out, F.coalesce(F.col("__passed") == 0, F.lit(False))).drop("__h", "__passed")


def split_frames(
    df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, by: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    marked = exact_split(df, key, fraction, seed, by, out="__test")
    return marked.where(~F.col("__test")).drop("__test"), marked.where("__test").drop("__test")


def validation_split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, by: str | None = None) -> DataFrame:
    """A second split of the training rows, from an independent hash, for early stopping."""
    return exact_split(df, key, fraction, seed + 1, by, out="is_validation")


def kfold_contiguous(df: DataFrame, order: str, k: int = 5, out: str = "fold", most: int = MOST_ROWS) -> DataFrame:
    """Folds of consecutive rows in `order` (numeric, unique, not null); the first `n % k`
    folds have one row more."""
    rows = _key_rows(df, order, None)
    ends = F.array(*[F.expr(f"{i} * (n div {k}) + least({i}, n % {k})") for i in range(1, k)])
    wanted = _classes(rows).withColumn("ranks", ends.cast("array<bigint>"))
    return _add_passed(df, None, [order], _cuts(rows, ["key"], wanted, most), out)


def kfold_stratified(
    df: DataFrame,
    label: str,
    order: str,
    k: int = 5,
    seed: int | None = None,
    out: str = "fold",
    most: int = MOST_ROWS,
) -> DataFrame:
    """Folds that share out each class evenly: in consecutive runs of `order` (numeric, unique, not null),
    or in hash order of it when a seed is given. The classes, in the order of their first rows, are dealt over the
    folds one row at a time, which fixes how many rows of each class a fold gets."""
    rows = _key_rows(df, order, label) if seed is None else _hash_rows(df, order, seed, label)
    ranged = bucket_by_sort(_classes(rows), ["first", CLASS])
    dealt = running(ranged, ["first", CLASS], sums={"past": F.col("n")})

    def upto(fold: int) -> Column:
        """Rows of the class in the folds up to this one."""
        shares = [f"(past - {f} + {k - 1}) div {k} - (past - n - {f} + {k - 1}) div {k}" for f in range(fold + 1)]
        return F.expr(" + ".join(shares))

    ends = F.array(*[upto(fold) for fold in range(k - 1)])
    wanted = dealt.withColumn("ranks", ends.cast("array<bigint>"))
    if seed is None:
        return _add_passed(df, label, [order], _cuts(rows, ["key"], wanted, most), out)
    hashed = df.withColumn("__h", stable_hash(F.col(order), seed))
    return _add_passed(hashed, label, ["__h", order], _cuts(rows, ["h", "key"], wanted, most), out).drop("__h")
