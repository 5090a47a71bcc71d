"""Metrics against direct computation, with ties and one-class labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import evaluate as V


def scored(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")


@pytest.fixture(scope="module", params=[1, 4, 16])
def sample(spark, request):
    rng = np.random.RandomState(5)
    s = np.round(rng.rand(400), 2)
    s[:140] = 0.5  # one score holds a third of the rows
    y = (rng.rand(400) < s).astype(int)
    return scored(spark, y, s).repartition(request.param), y, s


def test_roc_and_auc(sample):
    df, y, s = sample
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in V.roc_curve(df, "y", "s").collect()}
    for t in np.unique(s):
        hit = s >= t
        assert points[t] == pytest.approx((hit[y == 0].mean(), hit[y == 1].mean()))
    assert points[float("inf")] == (0.0, 0.0) and len(points) == len(np.unique(s)) + 1
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    assert V.roc_auc(df, "y", "s").first()[0] == pytest.approx(wins)


def test_roc_corners(sample):
    df, y, s = sample
    cuts = np.unique(s)[::-1]
    fps = np.array([((s >= t) & (y == 0)).sum() for t in cuts])
    tps = np.array([((s >= t) & (y == 1)).sum() for t in cuts])
    keep = np.r_[True, (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0), True]
    got = {r["threshold"] for r in V.roc_curve(df, "y", "s", corners_only=True).collect()}
    assert got == {float("inf"), *cuts[keep]}


def test_pr_and_average_precision(sample):
    df, y, s = sample
    rows = V.pr_curve(df, "y", "s").collect()
    points = {r["threshold"]: (r["precision"], r["recall"]) for r in rows}
    total, last = 0.0, 0.0
    for t in np.unique(s)[::-1]:
        hit = s >= t
        p, r = y[hit].mean(), hit[y == 1].mean()
        assert points[t] == pytest.approx((p, r))
        total, last = total + (r - last) * p, r
    assert points[None] == (1.0, 0.0)
    assert V.average_precision(df, "y", "s").first()[0] == pytest.approx(total)


def test_thresholds(sample):
    df, y, s = sample
    cuts = np.unique(s)
    f1, youden = [], []
    for t in cuts:
        hit = s >= t
        p, r = y[hit].mean(), hit[y == 1].mean()
        f1.append(2 * p * r / (p + r + 1e-6))
        youden.append(r - hit[y == 0].mean())
    for method in ("f1", "precision_recall"):
        assert V.best_threshold(df, "y", "s", method).first()["threshold"] == cuts[int(np.argmax(f1))]
    best = V.best_threshold(df, "y", "s", "youden").first()
    assert best["value"] == pytest.approx(max(youden))
    assert V.best_threshold(df, "y", "s", "other").first()["threshold"] == 0.5


def test_tied_best_cuts(spark):
    df = scored(spark, [1, 0, 1, 0], [0.9, 0.9, 0.1, 0.1])
    # Both cuts have J = 0, as does the start point, which has the highest threshold.
    assert V.best_threshold(df, "y", "s", "youden").first()["threshold"] == float("inf")
    both = scored(spark, [1, 0, 1, 0, 0, 0], [0.9, 0.8, 0.3, 0.3, 0.2, 0.1])
    assert V.best_threshold(both, "y", "s", "f1").first()["threshold"] in (0.9, 0.3)


def test_one_class_only(spark):
    df = scored(spark, [0, 0], [0.2, 0.4])
    assert V.roc_auc(df, "y", "s").first()[0] is None
    assert V.average_precision(df, "y", "s").first()[0] == 0.0
    assert all(r["recall"] == 1.0 for r in V.pr_curve(df, "y", "s").where("threshold IS NOT NULL").collect())
    r = V.binary_metrics(V.apply_threshold(df, "s", 0.9), "y", "prediction").first()
    assert tuple(r) == (1.0, 0.0, 0.0, 0.0)


def test_confusion_and_report(spark, rows):
    data = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    df = spark.createDataFrame(data, "y string, p string")
    cells = {(r[0], r[1]): r[2] for r in V.confusion_matrix(df, "y", "p").collect()}
    assert len(cells) == 9 and cells["a", "b"] == 2 and cells["c", "a"] == 1 and cells["b", "c"] == 0
    report = {r["class"]: r for r in V.classification_report(df, "y", "p").collect()}
    assert report["a"]["precision"] == pytest.approx(5 / 6) and report["a"]["recall"] == pytest.approx(5 / 7)
    assert report["c"]["precision"] == 0.0 and report["c"]["f1_score"] == 0.0 and report["c"]["support"] == 1
    assert report["accuracy"]["precision"] == pytest.approx(8 / 11)
    assert report["macro avg"]["recall"] == pytest.approx((5 / 7 + 1 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(8 / 11)


def test_regression_metrics(spark):
    y, p = np.array([1.0, 2.0, 0.0, 4.0]), np.array([1.5, 2.0, 1.0, 3.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = V.regression_metrics(df, "y", "p").first()
    assert r["mse"] == pytest.approx(((y - p) ** 2).mean())
    assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    m = V.mape(df, "y", "p").first()
    assert (m["mape"], m["zero_labels"]) == (pytest.approx(np.mean([0.5, 0, 0.25]) * 100), 1)


def test_model_comparison_marks_the_best(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 2.0)], "y double, p double, q double")
    got = V.model_comparison({"q": V.regression_metrics(df, "y", "q"), "p": V.regression_metrics(df, "y", "p")}).collect()
    assert [(r["model"], r["best"]) for r in got] == [("p", True), ("q", False)]


def test_prediction_columns_compare_in_one_pass(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.5, 2.0), (4.0, 3.0, 2.0)], "y double, p double, q double")
    one = {r["model"]: r for r in V.compare_predictions(df, "y", {"a": "p", "b": "q"}).collect()}
    two = {r["model"]: r for r in V.model_comparison({"a": V.regression_metrics(df, "y", "p"), "b": V.regression_metrics(df, "y", "q")}).collect()}
    assert one == two


def test_fold_summary(spark):
    folds = spark.createDataFrame([(0, 1.0), (1, 3.0)], "fold int, r2 double")
    r = V.summarize_folds(folds, ["r2"]).first()
    assert (r["mean"], r["std"], r["folds"]) == (2.0, 1.0, 2)
