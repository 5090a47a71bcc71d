"""Order-dependent operators against plain Python, for several layouts and a hot key."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import ordered as O

PARTITIONS = [1, 4, 16]


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with two thirds of the rows, ties and gaps in the values."""
    rng = np.random.RandomState(7)
    rows = []
    for i in range(3000):
        key = "hot" if rng.rand() < 0.66 else f"k{rng.randint(40)}"
        rows.append((i * 3, key, float(rng.randint(50)), None if rng.rand() < 0.8 else int(i)))
    return spark.createDataFrame(rows, "seq bigint, key string, x double, mark bigint"), rows


@pytest.mark.parametrize("parts", PARTITIONS)
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_and_lasts(skewed, parts, descending):
    df, rows = skewed
    ranged = O.bucket_by_range(df.repartition(parts), "seq")
    out = O.running(
        ranged, ["seq"], keys=["key"], sums={"total": F.col("x")}, lasts={"last": F.col("mark")}, descending=descending
    )
    got = {r["seq"]: (r["total"], r["last"]) for r in out.collect()}
    want, total, last = {}, {}, {}
    for seq, key, x, mark in sorted(rows, reverse=descending):
        total[key] = total.get(key, 0.0) + x
        if mark is not None:
            last[key] = mark
        want[seq] = (total[key], last.get(key))
    assert got == want


def test_hot_key_is_cut_into_buckets(skewed):
    df, rows = skewed
    sizes = O.bucket_by_range(df, "seq").groupBy("key", O.BUCKET).count().collect()
    assert max(r["count"] for r in sizes) < len(rows) / 16


@pytest.mark.parametrize("parts", PARTITIONS)
def test_dense_index_without_keys(skewed, parts):
    df, rows = skewed
    out = O.dense_index(df.select("seq").repartition(parts), ["seq"], "i")
    assert {r["seq"]: r["i"] for r in out.collect()} == {r[0]: i + 1 for i, r in enumerate(sorted(rows))}


@pytest.mark.parametrize("parts", PARTITIONS)
def test_exact_quantiles(spark, parts):
    rng = np.random.RandomState(3)
    a = np.round(rng.lognormal(3, 2, 5001), 2)
    b = np.where(rng.rand(5001) < 0.4, 7.0, rng.normal(0, 1, 5001))  # one value holds many rows
    data = [(float(x), float(y), None, float("nan")) for x, y in zip(a, b)]
    df = spark.createDataFrame(data, "a double, b double, none double, bad double").repartition(parts)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in O.exact_quantiles(df, ["a", "b", "none", "bad"], probs).collect()}
    assert set(k[0] for k in got) == {"a", "b"}
    for p in probs:
        assert got["a", p] == pytest.approx(np.quantile(a, p), rel=1e-12)
        assert got["b", p] == pytest.approx(np.quantile(b, p), rel=1e-12)


@pytest.mark.parametrize("values", [[5.0], [2.0, 2.0, 2.0], [1.0, 4.0]])
def test_exact_quantiles_of_few_rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = {r["prob"]: r["value"] for r in O.exact_quantiles(df, ["a"], [0.25, 0.5]).collect()}
    assert got == {p: pytest.approx(np.quantile(values, p)) for p in (0.25, 0.5)}


def test_approx_quantiles_are_near(spark):
    df = spark.range(100_000).select((F.col("id") * 37 % 100_000).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    out = O.approx_quantiles(df.repartition(7), ["a", "b"], [0.1, 0.5, 0.9]).collect()
    assert len(out) == 3
    for r in out:
        assert r["column"] == "a" and abs(r["value"] - r["prob"] * 100_000) < 500


@pytest.mark.parametrize("most", [1, 3, 40])
def test_exact_quantiles_cut_ranges_again(spark, most):
    """Ranges are cut until small: skew, one value in most rows, infinities, signed zeros."""
    rng = np.random.RandomState(5)
    inf = float("inf")
    a = np.concatenate([rng.lognormal(0, 6, 1500), np.full(3000, 2.5), [inf] * 40, [-inf] * 7])
    b = np.concatenate([np.full(4000, -0.0), np.zeros(500), rng.randint(0, 1 << 40, 47).astype(float)])
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(3)
    probs = [0.0, 0.01, 0.2, 0.3, 0.5, 0.75, 0.97, 0.995, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in O.exact_quantiles(df, ["a", "b"], probs, most=most).collect()}
    assert len(got) == 2 * len(probs)
    for name, data in (("a", np.sort(a)), ("b", np.sort(b))):
        for p in probs:
            at = (len(data) - 1) * p
            low, high = data[int(np.floor(at))], data[int(np.ceil(at))]
            assert got[name, p] == (low if low == high else pytest.approx(low + (high - low) * (at - np.floor(at))))


def test_no_task_sorts_more_than_asked(spark, monkeypatch):
    """Ten million rows of which nine are one value, the others within a range a millionth as wide as the whole."""
    n, most = 10_000_000, 20_000
    x = F.when(F.col("id") % 10 > 0, 7.0).when(F.col("id") == 0, 1e9).otherwise(7.0 + F.col("id") / (n * 1000.0))
    df = spark.range(n).select(x.alias("x"))
    sorted_, whole = [], O._counted_spans

    def noted(long, part, spans, wanted):
        if part == "value":
            sorted_.extend(s.n for s in spans)
        return whole(long, part, spans, wanted)

    monkeypatch.setattr(O, "_counted_spans", noted)
    got = {r["prob"]: r["value"] for r in O.exact_quantiles(df, ["x"], [0.5, 0.95, 0.99], most=most).collect()}
    ranked = sorted(7.0 + i / (n * 1000.0) for i in range(10, n, 10)) + [1e9]
    want = lambda at: ranked[at - 9_000_000] if at >= 9_000_000 else 7.0
    for p in (0.5, 0.95, 0.99):
        at = (n - 1) * p
        low, high = want(math.floor(at)), want(math.ceil(at))
        assert got[p] == low + (high - low) * (at - math.floor(at))
    assert sorted_ and max(sorted_) <= most
