"""Models against closed forms and direct solvers, and model handling."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from orrery.operators import encode as E, evaluate as V, importance as I, models as M, split as X
from orrery.sources.bundles import load_bundle, save_bundle
from orrery.sources.storage import work_folder


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.RandomState(0)
    x = rng.randn(200, 3)
    x = (x - x.mean(0)) / x.std(0)
    y = 50 + x @ [10.0, -4.0, 0.0] + 3 * rng.randn(200)
    df = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"])
    return df, x, y


def coordinate_descent(x, y, l1, l2):
    n, w = len(y), np.zeros(x.shape[1])
    yc = y - y.mean()
    for _ in range(2000):
        for j in range(len(w)):
            rest = yc - x @ w + x[:, j] * w[j]
            rho = x[:, j] @ rest / n
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (x[:, j] @ x[:, j] / n + l2)
    return w


def test_ols_and_ridge(regression):
    df, x, y = regression
    yc = y - y.mean()
    for kind, alpha in (("ols", 0.0), ("ridge", 25.0)):
        want = np.linalg.solve(x.T @ x + alpha * np.eye(3), x.T @ yc)
        got = M.fit_linear(df, kind=kind, alpha=alpha)
        assert np.allclose(got.coefficients.toArray(), want, rtol=1e-8)
        assert got.intercept == pytest.approx(y.mean())


def test_lasso_and_elastic_net(regression):
    df, x, y = regression
    lasso = M.fit_linear(df, kind="lasso", alpha=0.8).coefficients.toArray()
    assert np.allclose(lasso, coordinate_descent(x, y, 0.8, 0.0), rtol=1e-5, atol=1e-6)
    net = M.fit_linear(df, kind="elasticnet", alpha=0.5, l1_ratio=0.4).coefficients.toArray()
    assert np.allclose(net, coordinate_descent(x, y, 0.2, 0.3), rtol=1e-5, atol=1e-6)
    with pytest.raises(ValueError):
        M.fit_linear(df, kind="cubic")


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.RandomState(2)
    x = rng.randn(300, 2)
    y = (rng.rand(300) < 1 / (1 + np.exp(-(0.5 + x @ [1.5, -1.0])))).astype(float)
    df = spark.createDataFrame(
        [(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["id", "label", "features"]
    )
    return df.cache(), x, y


def newton(x, y, l2):
    z, w = np.hstack([np.ones((len(y), 1)), x]), np.zeros(x.shape[1] + 1)
    keep = np.diag([0.0] + [l2] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w = w - np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + keep, z.T @ (p - y) + keep @ w)
    return w


def test_logistic(classes):
    df, x, y = classes
    model = M.fit_logistic(df, C=0.1)
    want = newton(x, y, 10.0)
    assert np.allclose([model.intercept, *model.coefficients.toArray()], want, rtol=1e-5)
    sparse = M.fit_logistic(df, C=0.01, penalty="l1")
    assert np.count_nonzero(sparse.coefficients.toArray()) < 2


def test_class_weights(spark, classes):
    df, _, y = classes
    r = M.class_weights(df, "label").first()
    assert (r["positive"], r["total"], r["scale_pos_weight"]) == (y.sum(), 300, pytest.approx(y.sum() / (300 - y.sum())))
    only = M.class_weights(spark.createDataFrame([(0,), (0,)], "label int"), "label").first()
    assert (only["imbalance_ratio"], only["scale_pos_weight"]) == (float("inf"), 0.0)
    weights = {r["label"]: r["weight"] for r in M.balanced_weight(df, "label").select("label", "weight").distinct().collect()}
    assert weights[1.0] == pytest.approx(300 / (2 * y.sum()))


def pool(y, w):
    """Weighted isotonic fit by pooling neighbours."""
    blocks = []
    for v, n in zip(y, w):
        blocks.append([v, n, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return [v for v, _, k in blocks for _ in range(k)]


def test_isotonic(spark):
    rng = np.random.RandomState(4)
    s = np.round(rng.rand(500), 2)
    y = (rng.rand(500) < s**2).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s0 double, y int").repartition(5)
    model = M.isotonic_calibration(df, "y", "s0")
    got = {r["s0"]: r["p"] for r in M.apply_calibration(df, model, "s0", out="p").collect()}
    cuts = np.unique(s)
    want = pool([y[s == c].mean() for c in cuts], [(s == c).sum() for c in cuts])
    assert [got[c] for c in cuts] == pytest.approx(want)


def test_searches(spark, classes):
    df, _, _ = classes
    folds = X.kfold_stratified(df, "label", "id", k=3, seed=1)
    lr = LogisticRegression(standardization=False, maxIter=20)
    found = M.search(folds, lr, M.logistic_maps(lr, 300, {"C": [1e-5, 1], "penalty": ["l1", "l2"]}), "fold")
    table = M.search_results(spark, found).collect()
    assert len(table) == 4 and sum(r["best"] for r in table) == 1
    assert max(r["score"] for r in table) > 0.75
    assert M.grid_search(folds, lr, {"regParam": [0.01, 0.1]}, "fold").bestModel.coefficients.size == 2


def test_draws_are_seeded_and_different():
    lr = LogisticRegression()
    space = {"regParam": [0.1, 0.2, 0.3], "maxIter": [5, 10]}
    a, b = M.drawn_maps(lr, space, 4, seed=3), M.drawn_maps(lr, space, 4, seed=3)
    assert a == b and len({tuple(sorted((p.name, v) for p, v in m.items())) for m in a}) == 4
    assert len(M.drawn_maps(lr, space, 100)) == 6


def test_cross_validation_per_fold(classes):
    df, _, _ = classes
    folds = X.kfold_stratified(df, "label", "id", k=3, seed=1)
    scores = {r["fold"]: r for r in M.cross_validate(folds, LogisticRegression(maxIter=20), "fold").collect()}
    assert sorted(scores) == [0, 1, 2]
    out = M.positive_probability(M.cross_predict(folds, LogisticRegression(maxIter=20), "fold", 3)).where("fold = 1")
    assert scores[1]["roc_auc"] == pytest.approx(V.roc_auc(out, "label", "score").first()[0])
    assert scores[1]["average_precision"] == pytest.approx(V.average_precision(out, "label", "score").first()[0])
    assert scores[1]["f1_score"] == pytest.approx(V.binary_metrics(out, "label", "prediction").first()["f1_score"])


def test_class_column_may_have_many_values(spark):
    df = spark.range(2000).withColumn("label", F.col("id").cast("double"))
    for use in (
        lambda: X.exact_split(df, "id", by="label").where("is_test"),
        lambda: X.kfold_stratified(df, "label", "id").where("fold = 0"),
        lambda: M.balanced_weight(df, "label").where("weight = 1").limit(400),
    ):
        assert use().count() == 400


def test_cross_predict_covers_every_row(classes):
    df, _, _ = classes
    folds = X.kfold_stratified(df, "label", "id", k=3)
    out = M.cross_predict(folds, LogisticRegression(maxIter=10), "fold", 3)
    assert out.select("id").distinct().count() == 300 == out.count()


def test_trees_importance_and_early_stop(spark, classes):
    df, _, _ = classes
    marked = X.exact_split(df, "id", by="label", out="is_validation").cache()
    model, rounds = M.early_stopping(marked, M.boosted_classifier(rounds=15, depth=2), "is_validation")
    assert 1 <= rounds <= 15 and model.getNumTrees == rounds
    weight = I.importance_weight(spark, model, ["a", "b"]).collect()
    splits = sum(t.toDebugString.count("If (feature") for t in model.trees)
    by_name = {r["feature"]: r["importance"] for r in weight}
    first = sum(t.toDebugString.count("If (feature 0 ") for t in model.trees)
    assert by_name["a"] == pytest.approx(first / splits) and sum(by_name.values()) == pytest.approx(1)
    trees = I.importance_trees(spark, model, ["a", "b"])
    assert I.topk_features(trees, 1).first()["feature"] == "a"
    with pytest.raises(ValueError):
        I.importance_trees(spark, model, ["a"])


def test_saved_model_scores_the_same(spark, rows):
    data = [(i, float(i % 5), "uvw"[i % 3], float(i % 5 > 2)) for i in range(60)]
    df = spark.createDataFrame(data, "id int, x double, c string, label double")
    prepare = E.column_transformer(df, ["x"], ["c"])
    model = PipelineModel([*prepare.stages, M.fit_logistic(prepare.transform(df))])
    path = work_folder(spark, "model")
    save_bundle(path, model, {"classes": M.class_weights(df, "label")})
    again, tables = load_bundle(spark, path, ["classes"])

    def scores(m):
        return rows(M.batch_scoring(df, m).select("id", "approval_probability", "prediction", "confidence"))

    assert scores(again) == scores(model)
    assert tables["classes"].first()["total"] == 60
    assert {r[2] for r in scores(model)} == {"Approved", "Rejected"}


def test_decide(spark):
    df = spark.createDataFrame([(0.5,), (0.2,)], "p double")
    got = [(r["prediction"], r["confidence"]) for r in M.decide(df, "p").collect()]
    assert got == [("Approved", 50.0), ("Rejected", 80.0)]
    assert V.apply_threshold(df, "p", 0.5).where("prediction = 1").count() == 1


@pytest.fixture(scope="module")
def boosted(spark):
    rng = np.random.RandomState(3)
    x = rng.randn(400, 3)
    y = (x[:, 0] + 0.7 * x[:, 1] * x[:, 2] + rng.randn(400) > 0).astype(float)
    df = spark.createDataFrame(
        [(i, float(b), i % 4 == 0, Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["id", "label", "held", "features"]
    ).repartition(3).cache()
    return df, M.boosted_classifier(rounds=12, depth=3).fit(df.where("NOT held"))


def test_staged_scores_end_at_the_model(boosted):
    """The last stage is the model's own probability, an earlier one that of the first trees alone."""
    df, model = boosted
    stages = {(r["id"], r["round"]): r["score"] for r in M.staged_scores(model, df, ["id"]).collect()}
    assert len(stages) == 400 * 12
    for r in M.positive_probability(model.transform(df)).collect():
        assert stages[r["id"], 12] == pytest.approx(r["score"], rel=1e-12)
    trees = [t.transform(df.select("id", "features")).select("id", "prediction").collect() for t in model.trees[:4]]
    margin = {}
    for weight, rows in zip(model.treeWeights, trees):
        for r in rows:
            margin[r["id"]] = margin.get(r["id"], 0.0) + weight * r["prediction"]
    for i, m in margin.items():
        assert stages[i, 4] == pytest.approx(1 / (1 + np.exp(-2 * m)), rel=1e-12)


def test_validation_curves(boosted):
    df, model = boosted
    held = df.where("held")
    losses = {r["round"]: r["value"] for r in M.validation_curve(model, held).collect()}
    assert [2 * losses[i + 1] for i in range(12)] == pytest.approx(model.evaluateEachIteration(held), rel=1e-9)
    scores = M.staged_scores(model, held, ["label"]).toPandas()
    want = {}
    for n, part in scores.groupby("round"):
        pos, neg = part[part["label"] == 1]["score"].to_numpy(), part[part["label"] == 0]["score"].to_numpy()
        want[n] = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    areas = {r["round"]: r["value"] for r in M.validation_curve(model, held, metric="areaUnderROC").collect()}
    assert areas == {n: pytest.approx(v) for n, v in want.items()}
    assert M.validation_curve(model, held.limit(0)).count() == 0
    with pytest.raises(ValueError):
        M.validation_curve(model, held, metric="other")


@pytest.mark.parametrize(
    "values, patience, larger, want",
    [
        ([3, 2, 1, 2, 2, 0], 2, False, (3, 1.0, 5)),  # the later 0 is never seen
        ([3, 2, 1, 2, 2, 0], 3, False, (6, 0.0, 6)),
        ([1, 1, 1, 1], 2, True, (1, 1.0, 3)),  # equal is not better
        ([1, float("nan"), 2, None, 3], 2, True, (5, 3.0, 5)),
        ([None, 2, 1], 5, True, (2, 2.0, 3)),
        ([None, float("nan")], 5, True, (1, None, 2)),
        ([4], 1, True, (1, 4.0, 1)),
        ([5, 4, 3, 2], 1, False, (4, 2.0, 4)),
    ],
)
def test_stop_on_a_curve(spark, values, patience, larger, want):
    rows = [(i + 1, None if v is None else float(v)) for i, v in enumerate(values)]
    curve = spark.createDataFrame(rows, "round int, value double").repartition(3)
    assert tuple(M.stopped_round(curve, patience, larger).first()) == want
    spaced = curve.withColumn("round", F.col("round") * 10)
    best, value, last = M.stopped_round(spaced, patience, larger).first()
    assert (best / 10, value, last / 10) == want


def test_rounds_follow_the_curve(boosted):
    df, model = boosted
    curve = M.validation_curve(model, df.where("held"), metric="areaUnderPR")
    best = M.stopped_round(curve, 3, True).first()["best_round"]
    fitted, rounds = M.early_stopping(df, M.boosted_classifier(rounds=12, depth=3), "held", 3, "areaUnderPR")
    assert rounds == best == fitted.getNumTrees


@pytest.mark.parametrize("alpha", [0.0, 25.0])
def test_linear_folds_from_cross_products(spark, alpha):
    """Against a solver per fold; a feature far from zero, one that repeats another, and rows with nulls."""
    rng = np.random.RandomState(9)
    x = rng.randn(300, 3) * [1, 50, 0.1] + [0, 1e6, 3]
    y = x @ [2.0, 0.3, -7.0] + rng.randn(300)
    data = [(i % 4, *map(float, a), float(a[0]), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*data, (0, None, 1.0, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0, 1.0, 1.0)], "part int, a double, b double, c double, d double, y double")
    got = {r["fold"]: r for r in M.cross_validate_linear(df.repartition(5), ["a", "b", "c", "d"], "y", "part", alpha).collect()}
    assert set(got) == {0, 1, 2, 3}
    full, part = np.column_stack([x, x[:, 0]]), np.arange(300) % 4
    for f in range(4):
        train, test = part != f, part == f
        mx, my = full[train].mean(0), y[train].mean()
        c = full[train] - mx
        w = np.linalg.lstsq(c.T @ c + alpha * np.eye(4), c.T @ (y[train] - my), rcond=None)[0]
        miss = y[test] - (my + (full[test] - mx) @ w)
        assert got[f]["rmse"] == pytest.approx(np.sqrt((miss**2).mean()), rel=1e-6)
        assert got[f]["mae"] == pytest.approx(np.abs(miss).mean(), rel=1e-6)
        assert got[f]["r2"] == pytest.approx(1 - (miss**2).sum() / ((y[test] - y[test].mean()) ** 2).sum(), rel=1e-6)
    assert M.cross_validate_linear(df.limit(0), ["a"], "y", "part").count() == 0
