"""Splits and folds: sizes, balance, and independence of the layout."""

import math

import pytest
from pyspark.sql import functions as F

from orrery.operators import split as X


def table(spark, n=1003):
    return spark.range(n).select(
        (F.col("id") * 7).alias("key"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 100 == 1, "c").otherwise("b").alias("y")
    )


def test_exact_size_and_layout(spark):
    df = table(spark)
    picks = [
        {r["key"] for r in X.exact_split(df.repartition(p), "key").where("is_test").collect()} for p in (1, 4, 16)
    ]
    assert picks[0] == picks[1] == picks[2]
    assert len(picks[0]) == math.ceil(0.2 * 1003)
    other = {r["key"] for r in X.exact_split(df, "key", seed=7).where("is_test").collect()}
    assert other != picks[0]


def test_stratified_sizes(spark):
    out = X.exact_split(table(spark), "key", by="y").groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")
    ).collect()
    assert sum(r["t"] for r in out) == math.ceil(0.2 * 1003)
    assert all(abs(r["t"] - 0.2 * r["n"]) <= 1 for r in out)


def test_tiny_inputs(spark):
    assert X.exact_split(table(spark, 1), "key").where("is_test").count() == 1
    assert X.exact_split(table(spark, 4), "key", by="y").where("is_test").count() == 1


def test_fast_split_is_near_and_stable(spark):
    df = table(spark, 20000)
    a = {r["key"] for r in X.fast_split(df, "key").where("is_test").collect()}
    assert a == {r["key"] for r in X.fast_split(df.repartition(3), "key").where("is_test").collect()}
    assert abs(len(a) - 4000) < 200


def test_validation_is_part_of_training(spark):
    train, test = X.split_frames(table(spark), "key", by="y")
    assert train.count() + test.count() == 1003
    marked = X.validation_split(train, "key", by="y")
    assert marked.where("is_validation").count() == math.ceil(0.2 * train.count())


@pytest.mark.parametrize("n,k", [(10, 3), (11, 5), (4, 5), (1003, 5)])
def test_contiguous_folds(spark, n, k):
    folds = [r["fold"] for r in X.kfold_contiguous(table(spark, n).repartition(4), "key", k).orderBy("key").collect()]
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    assert folds == [i for i, size in enumerate(sizes) for _ in range(size)]


@pytest.mark.parametrize("seed", [None, 42])
def test_stratified_folds(spark, seed):
    df, k = table(spark, 503), 5
    picks = [
        {r["key"]: (r["y"], r["fold"]) for r in X.kfold_stratified(df.repartition(p), "y", "key", k, seed).collect()}
        for p in (1, 8)
    ]
    assert picks[0] == picks[1] and len(picks[0]) == 503
    first = {}
    for key, (y, _) in sorted(picks[0].items()):
        first.setdefault(y, key)
    classes = sorted((y for y, _ in picks[0].values()), key=first.get)  # in the order of their first rows
    for c in set(classes):
        want = [sum(1 for j, y in enumerate(classes) if y == c and j % k == i) for i in range(k)]
        assert [sum(1 for v in picks[0].values() if v == (c, i)) for i in range(k)] == want
    if seed is None:
        for c in set(classes):
            in_order = [f for _, (y, f) in sorted(picks[0].items()) if y == c]
            assert in_order == sorted(in_order)


@pytest.mark.parametrize("most", [1, 10, 100_000])
def test_ranges_are_cut_until_small(spark, most):
    """The same rows whatever the most rows that are sorted at once; a hot class, skewed and huge keys."""
    hot = spark.range(2000).select(
        F.when(F.col("id") < 1990, F.col("id")).otherwise(F.col("id") * F.lit(10**14)).alias("key"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("y"),
    ).repartition(5)
    rows = {r["key"]: r for r in X.kfold_contiguous(hot, "key", 7, most=most).collect()}
    sizes = [286] * 5 + [285] * 2
    assert [rows[k]["fold"] for k in sorted(rows)] == [i for i, n in enumerate(sizes) for _ in range(n)]
    for mark in (
        lambda m: X.exact_split(hot, "key", by="y", most=m),
        lambda m: X.kfold_stratified(hot, "y", "key", 4, most=m),
        lambda m: X.kfold_stratified(hot, "y", "key", 4, seed=5, most=m),
    ):
        assert sorted(map(tuple, mark(most).collect())) == sorted(map(tuple, mark(1_000_000).collect()))


def test_largest_remainder_over_many_classes(spark):
    """Shares of classes of many sizes against plain Python, ties to the first class in text order."""
    counts = {f"k{i:04d}": 1 + i * i % 11 for i in range(900)}
    df = spark.createDataFrame(list(counts.items()), "__class string, n bigint").repartition(9)
    got = {r["__class"]: r["n_test"] for r in X.split_sizes(df, 0.3).collect()}
    total = sum(counts.values())
    train = total - math.ceil(total * 0.3)
    quota = {c: n * train / total for c, n in counts.items()}
    kept = {c: math.floor(q) for c, q in quota.items()}
    for c in sorted(quota, key=lambda c: (kept[c] - quota[c], c))[: train - sum(kept.values())]:
        kept[c] += 1
    assert got == {c: n - kept[c] for c, n in counts.items()}
    assert X.split_sizes(df.limit(0), 0.3).count() == 0


def test_as_many_classes_as_rows(spark):
    df = spark.range(5000).select("id", (F.col("id") * 31 % 5000).alias("y"))
    assert X.exact_split(df, "id", by="y").where("is_test").count() == 1000
    folds = X.kfold_stratified(df, "y", "id", 5).groupBy("fold").count().collect()
    assert {r["fold"]: r["count"] for r in folds} == {i: 1000 for i in range(5)}


def test_no_rows(spark):
    df = table(spark).limit(0)
    assert X.exact_split(df, "key", by="y").count() == 0
    assert X.exact_split(df, "key").count() == 0
    assert X.kfold_stratified(df, "y", "key").count() == 0
    assert X.kfold_contiguous(df, "key").count() == 0
