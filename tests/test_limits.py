"""No cap, switch or guard changes a result."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators import clean as C, combine as J, documents as D, features as X, models as M, ordered as O, profile as P, retrieve as R, split as S


@pytest.fixture
def view(spark):
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string").createOrReplaceTempView("things")


@pytest.mark.parametrize(
    "statement",
    [
        "SELECT reflect/**/('java.lang.Math', 'abs', -3) FROM things",
        "SELECT `reflect`('java.lang.Math', 'abs', -3)",
        "SELECT java_method('java.lang.Math', 'abs', -3)",
        "SELECT try_reflect('java.lang.Math', 'abs', -3)",
        "SELECT id FROM things WHERE name = (SELECT reflect('java.lang.System', 'getProperty', 'user.name'))",
        "SELECT * FROM (SELECT reflect('java.lang.Math', 'abs', id) FROM things)",
        "SELECT TRANSFORM(id) USING 'cat' AS (x) FROM things",
        "DROP VIEW things",
        "WITH c AS (SELECT 1) SELECT * FROM c",
    ],
)
def test_guard_refuses(spark, view, statement):
    assert [r["error"] for r in J.sql_select(spark, statement).collect()] == [J.ONLY_SELECT]


def test_guard_reads_no_files(spark, view, tmp_path):
    (tmp_path / "a.txt").write_text("secret")
    (row,) = J.sql_select(spark, f"SELECT * FROM text.`{tmp_path}/a.txt`").collect()
    assert row["error"].startswith(J.FAILED) and spark.conf.get(J.ON_FILES) == "true"


@pytest.mark.parametrize(
    "statement, want",
    [
        ("SELECT transform(array(id), x -> x + 1)[0] AS v FROM things a JOIN (SELECT 1 AS id) b USING (id)", [2]),
        ("SELECT 'we reflect (briefly)' AS v FROM things", ["we reflect (briefly)"] * 2),
        ("select count(*) AS v from things", [2]),
    ],
)
def test_guard_accepts(spark, view, statement, want):
    assert [r["v"] for r in J.sql_select(spark, statement).collect()] == want


def test_many_classes(spark):
    df = spark.range(3000).select("id", (F.col("id") % 600).alias("y"))
    split = S.exact_split(df, "id", 0.2, by="y").groupBy("y").agg(F.count_if("is_test").alias("n")).collect()
    assert {r["n"] for r in split} == {1} and len(split) == 600
    folds = S.kfold_stratified(df, "y", "id", k=5).groupBy("y", "fold").count().collect()
    assert len(folds) == 3000 and {r["count"] for r in folds} == {1}
    weights = {r["weight"] for r in M.balanced_weight(df, "y").select("weight").distinct().collect()}
    assert weights == {1.0}
    few = df.withColumn("y", F.col("y") % 40)  # joined cut points against those in the plan
    joined = {r["id"]: r["is_test"] for r in S.exact_split(few, "id", by="y").collect()}
    old, S.IN_PLAN = S.IN_PLAN, 100
    try:
        assert joined == {r["id"]: r["is_test"] for r in S.exact_split(few, "id", by="y").collect()}
    finally:
        S.IN_PLAN = old


def test_fold_classes_in_order_of_appearance(spark):
    df = spark.createDataFrame(list(enumerate([1, 1, 1, 1, 0, 0, 0, 0])), "i int, y int")
    got = S.kfold_stratified(df, "y", "i", k=3).groupBy("fold", "y").count().collect()
    sizes = {(r["fold"], r["y"]): r["count"] for r in got}
    assert sizes == {(0, 1): 2, (1, 1): 1, (2, 1): 1, (0, 0): 1, (1, 0): 2, (2, 0): 1}


def test_infinities_are_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (2.0,), (inf,), (float("nan"),), (None,)], "x double")
    row = P.describe_numeric(df, ["x"]).first()
    assert (row["count"], row["min"], row["max"], row["q50"]) == (3, 1.0, inf, 2.0)
    assert sorted(r["x"] for r in C.impute_median(df, ["x"]).collect()) == [1.0, 2.0, 2.0, 2.0, inf]
    assert sum(r["x_missing"] for r in C.missing_indicator(df, ["x"]).collect()) == 2
    ends = spark.createDataFrame([(inf,), (inf,), (-inf,)], "x double")
    assert {r["prob"]: r["value"] for r in O.exact_quantiles(ends, ["x"], [0.0, 1.0]).collect()} == {0.0: -inf, 1.0: inf}


def test_a_thousand_bins(spark):
    x = np.concatenate([np.linspace(-3, 7, 1001), np.random.default_rng(1).uniform(-3, 7, 500)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    want = {}
    lo, step = x.min(), (x.max() - x.min()) / 1000
    for v in x:
        want[float(v)] = sum(v > lo + i * step for i in range(1, 1000))
    assert {r["x"]: r["b"] for r in X.cut_equal_width(df, "x", 1000, "b").collect()} == want


def test_correlations_equal_pandas(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(5e6, 1, (400, 6)), columns=list("abcdef"))
    frame["g"] = frame["a"] * 2 + rng.normal(0, 0.1, 400)
    frame["h"] = 3.3
    frame = frame.mask(rng.random(frame.shape) < 0.2)
    frame["i"] = np.nan
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in frame.itertuples(index=False)], ", ".join(f"{c} double" for c in frame))
    want = frame.corr()
    for r in P.correlation_matrix(df, list(frame)).collect():
        w = want.loc[r["a"], r["b"]]
        if r["a"] == r["b"] != "i":
            assert r["corr"] == 1.0
        elif math.isnan(w):
            assert r["corr"] is None
        else:
            assert math.isclose(r["corr"], w, rel_tol=1e-8, abs_tol=1e-9)


def test_wide_correlations(spark):
    wide = spark.range(2000).select(*[F.rand(i).alias(f"c{i}") for i in range(80)])
    assert P.correlation_matrix(wide, wide.columns).where("corr IS NOT NULL").count() == 6400


def test_lookup_gives_as_many_as_asked(spark):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("I").alias("bob"), F.lit("1").alias("modda"))
    asked = spark.createDataFrame([(1, "I", "1", 12), (2, "I", None, 3)], "q int, chapter string, article string, k int")
    assert {r["q"]: r["count"] for r in R.metadata_lookup(asked, docs, ["doc_id"]).groupBy("q").count().collect()} == {1: 12, 2: 3}


def test_paged_articles_parse_each_page_once(spark):
    page = "\n".join(f"{i}-modda\ntext {i}" for i in range(1500))
    df = spark.createDataFrame([(1, 1, page), (1, 2, "1501-modda\nlast")], "doc int, page int, text string")
    out = D.articles(df, "doc", "text", "page")
    assert "Filter (size(" not in out._jdf.queryExecution().optimizedPlan().toString()  # would hold the whole parse
    assert out.count() == 1501
