"""Bands, ratios, imputation and profiling at their edges."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.functions.binning import cut_left, cut_right
from orrery.functions.numeric import safe_divide, truncate
from orrery.operators import clean as C, encode as E, features as X, profile as P

INF = float("inf")


def column(spark, values, name="x"):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"i int, {name} double")


def taken(df, expr):
    return [r[1] for r in df.select("i", expr).orderBy("i").collect()]


def test_cut_right_edges(spark):
    df = column(spark, [18, 18.5, 25, 26, 65, 66, None, float("nan"), -5])
    got = taken(df, cut_right(F.col("x"), X.AGE_EDGES, X.AGE_LABELS))
    assert got == [None, "18-24", "18-24", "25-34", "50-64", "65+", None, None, None]


def test_cut_right_include_lowest(spark):
    df = column(spark, [0, 5, 5.1, 100, 100.5])
    got = taken(df, cut_right(F.col("x"), X.HOUSE_AGE_EDGES, X.HOUSE_AGE_LABELS, include_lowest=True))
    assert got == ["0-5", "0-5", "6-15", "51+", None]


def test_cut_left_edges(spark):
    df = column(spark, [-1, 0, 1, 2, 3, 6, 7, None])
    got = taken(df, cut_left(F.col("x"), X.PAST_DUE_EDGES, X.PAST_DUE_LABELS))
    assert got == ["0", "1", "2-3", "2-3", "4-6", "6+", "6+", None]


def test_safe_divide(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 4.0), (1, 1.0, 0.0), (2, 0.0, 0.0), (3, None, 2.0), (4, 1.0, None), (5, float("nan"), 1.0), (6, INF, 2.0), (7, 3.0, INF)],
        "i int, a double, b double",
    )
    assert taken(df, safe_divide(F.col("a"), F.col("b"), 0)) == [0.25, 0, 0, 0, 0, 0, 0, 0]
    assert taken(df, safe_divide(F.col("a"), F.col("b")))[1] is None


def test_truncate(spark):
    df = column(spark, [1.9, -1.9, None, 3e12, float("nan")])
    assert taken(df, truncate(F.col("x"))) == [1, -1, None, None, None]


@pytest.mark.parametrize("values,bins,want", [
    ([0, 1, 2, 3, 4], 4, [0, 0, 1, 2, 3]),
    ([5, 5, 5], 4, [1, 1, 1]),
    ([5, 5], 3, [1, 1]),
    ([0.0, 10.0, 2.5, 2.5000001, None], 4, [0, 3, 0, 1, None]),
])
def test_cut_equal_width(spark, values, bins, want):
    out = X.cut_equal_width(column(spark, [None if v is None else float(v) for v in values]), "x", bins, "b")
    assert taken(out, F.col("b")) == want


def test_imputation_fits_on_other_rows(spark):
    train, test = column(spark, [1.0, 2.0, 10.0, None]), column(spark, [None, 4.0, float("nan")])
    assert taken(C.impute_median(test, ["x"], fit_on=train), F.col("x")) == [2.0, 4.0, 2.0]
    assert taken(C.impute_mean(test, ["x"], fit_on=train), F.col("x")) == [pytest.approx(13 / 3), 4.0, pytest.approx(13 / 3)]


def test_log1p_only_for_non_negative_columns(spark):
    df = spark.createDataFrame([(0.0, -1.0), (3.0, 2.0)], "a double, b double")
    out = X.log1p_features(df, ["a", "b", "c"])
    assert out.columns == ["a", "b", "log1p_a"]


def test_credit_features_skip_absent_columns(spark):
    df = spark.createDataFrame([(1, 30.0)], "client_id int, age double")
    assert X.credit_features(df).columns == ["client_id", "age", "age_group"]
    whole = spark.createDataFrame(
        [(18.0, 0.0, 0, 100.0, 10.0, 50.0, 20.0)],
        "age double, employment_years double, past_due int, income double, monthly_expenses double, loan_amount double, savings_balance double",
    )
    r = X.credit_features(whole).first()
    assert (r["age_group"], r["past_due_category"], r["employment_stability"]) == ("nan", "1", "<1")
    assert (r["disposable_income"], r["savings_rate"], r["debt_to_income"]) == (-20.0, 0.2, 0.5)
    assert (r["years_employed_per_age"], r["expense_ratio_category"], r["is_employed_stable"]) == (0.0, ">100%", 0)


def test_engineering_fits_on_training_rows(spark):
    train = spark.createDataFrame([(1, 10.0, 4.0), (2, 20.0, None), (3, 30.0, 8.0)], "client_id int, income double, savings_balance double")
    test = spark.createDataFrame([(4, None, 2.0), (5, 10.0, None)], "client_id int, income double, savings_balance double")
    got = {r["client_id"]: r for r in X.engineer_credit(test, fit_on=train).collect()}
    assert (got[4]["income"], got[5]["savings_balance"]) == (20.0, 6.0)
    assert (got[4]["savings_balance_missing"], got[5]["savings_balance_missing"]) == (0, 1)
    assert "income_missing" not in got[4].asDict()
    assert got[5]["savings_to_income"] == 0.0 and got[4]["log1p_income"] == pytest.approx(math.log1p(20.0))


def test_house_features(spark):
    df = spark.createDataFrame([(2.0, 5, 1, 1), (3.0, 0, 1, 0)], "distance_to_center double, age int, has_garage int, has_garden int")
    got = X.house_features(df).collect()
    assert [tuple(r)[4:] for r in got] == [(10.0, 4.0, 1, "0-5"), (0.0, 9.0, 0, "0-5")]


def test_leakage_guard(spark):
    df = spark.createDataFrame([(1, "n", 0.5, "Y", 3)], "client_id int, full_name string, risk_score double, approve_credit string, age int")
    kept = C.leakage_guard(df, "approve_credit", ["approve_credit"], ["client_id", "full_name"], ["risk_score"])
    assert kept.columns == ["age", "approve_credit"]
    with pytest.raises(ValueError):
        C.leakage_guard(df, "age", ["approve_credit"], [], [])


def test_range_validation_counts_unknown_choices_and_missing(spark):
    df = spark.createDataFrame([(17, "male"), (18, "Male"), (100, None), (None, "Other")], "age int, gender string")
    got = {r["field"]: (r["checked"], r["violations"]) for r in C.range_validation(df).collect()}
    assert got == {"age": (4, 2), "gender": (4, 2)}


def test_map_labels_and_missing_indicator(spark):
    df = spark.createDataFrame([("N", 1.0), ("Y", None), ("?", float("nan"))], "a string, x double")
    out = C.missing_indicator(C.map_labels(df, "a", {"N": 0, "Y": 1}, "y"), ["x", "y"])
    assert [(r["y"], r["x_missing"], r["y_missing"]) for r in out.collect()] == [(0, 0, 0), (1, 1, 0), (None, 1, 1)]


def test_histogram_counts_like_numpy(spark):
    rng = np.random.RandomState(0)
    x = np.round(rng.gamma(2, 10, 2000), 1)
    df = column(spark, [float(v) for v in x])
    for bins in (30, "auto"):
        n, edges = np.histogram(x, bins=bins)
        got = P.histogram(df, "x", bins).orderBy("bin").collect()
        assert [r["n"] for r in got] == list(n)
        assert np.allclose([r["left_edge"] for r in got], edges[:-1])


def test_histogram_of_constant_and_empty(spark):
    got = P.histogram(column(spark, [4.0, 4.0]), "x", 2).orderBy("bin").collect()
    assert [(r["left_edge"], r["n"]) for r in got] == [(3.5, 0), (4.0, 2)]
    assert P.histogram(column(spark, [None]), "x", 3).agg(F.sum("n")).first()[0] == 0


def test_kde_matches_direct_sum(spark):
    x = np.array([1.0, 2.0, 2.0, 5.0, 9.0])
    got = P.kde_grid(column(spark, [float(v) for v in x]), "x", 11).orderBy("point").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    for r in got:
        want = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, rel=1e-12)


def test_chi_square_with_empty_cell(spark):
    df = spark.createDataFrame([("a", "u")] * 6 + [("a", "v")] * 2 + [("b", "u")] * 4, "a string, b string")
    r = P.chi_square(df, "a", "b").first()
    seen = np.array([[6, 2], [4, 0]], dtype=float)
    expected = seen.sum(1, keepdims=True) @ seen.sum(0, keepdims=True) / seen.sum()
    assert r["statistic"] == pytest.approx(((seen - expected) ** 2 / expected).sum())
    assert r["dof"] == 1


def test_encoders(spark, rows):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "Z")], "i int, c string")
    assert rows(E.label_encode(df, "c", "code").select("i", "code")) == [(1, 2), (2, 1), (3, 3), (4, 0)]
    assert rows(E.label_encode(df, "c", "code", small=2).select("i", "code")) == [(1, 2), (2, 1), (3, 3), (4, 0)]
    flags = E.onehot_columns(df, "c", drop_first=True)
    assert flags.columns == ["i", "c", "c_a", "c_b"]
    assert rows(flags.select("i", "c_a", "c_b")) == [(1, 0, 1), (2, 1, 0), (3, 0, 0), (4, 0, 0)]
    with pytest.raises(ValueError):
        E.column_levels(df, "c", limit=2)


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = [tuple(r) for r in E.standard_scale(df, ["a", "b"]).collect()]
    assert sorted(got) == [(-1.0, 0.0), (1.0, 0.0)]


def test_transformer_gives_unseen_levels_zeros(spark):
    train = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (4.0, "x")], "a double, c string")
    model = E.column_transformer(train, ["a"], ["c"])
    assert E.output_names(model, ["a"], ["c"]) == ["a", "c_x", "c_y"]
    test = spark.createDataFrame([(1.0, "new"), (2.0, None), (4.0, "y")], "a double, c string")
    got = [list(r["features"].toArray()) for r in model.transform(test).collect()]
    a = np.array([1.0, 2.0, 4.0])
    assert np.allclose([g[0] for g in got], (a - a.mean()) / a.std())
    assert [g[1:] for g in got] == [[0, 0], [0, 0], [0, 1]]
