"""Recorded model results on a house price table.

Set GOLDEN_HOUSES to a CSV with the columns city, area, rooms, age, distance_to_center,
has_garage, has_garden and price (500 rows) to run these; the table is not part of this repository."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import encode as E, evaluate as V, features as X, importance as I, models as M
from orrery.sources.tables import scan_csv

PATH = os.environ.get("GOLDEN_HOUSES", "")
pytestmark = pytest.mark.skipif(not os.path.isfile(PATH), reason="GOLDEN_HOUSES is not set")

NUMERIC = ["rooms", "age", "distance_to_center", "distance_age_interaction", "distance_squared"]
CATEGORICAL = ["city", "age_group", "has_garage", "has_garden", "has_garage_and_garden"]

# Recorded: RMSE, MAE, MAPE, R2, and mean and deviation of R2 over five folds.
RECORDED = {
    "ols": (196710.04919821833, 169845.34475380514, 45.42680188321238, -0.14350139908163184, -0.019112916568758777, 0.08149972848488153),
    "lasso": (196709.95926950534, 169845.33170073852, 45.426817862711374, -0.14350035354698787, -0.019110518807900267, 0.08149718608411818),
    "ridge": (196482.83360869382, 169722.65015797797, 45.411524888500765, -0.14086125651116954, -0.01659444048399057, 0.07862005928090868),
    "elasticnet": (194842.2811745394, 168824.54612253196, 45.38734654266863, -0.12188932958814158, -0.004190334674549235, 0.06191578482080458),
}
ALPHA = {"ols": 0.0, "lasso": 0.1, "ridge": 1.0, "elasticnet": 0.1}


@pytest.fixture(scope="module")
def houses(spark):
    """The rows with their place in the recorded order: 100 test rows, then the training rows."""
    raw = scan_csv(spark, PATH)
    indexed = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(raw.collect())], "row int, " + ", ".join(f"{n} {t}" for n, t in raw.dtypes)
    )
    place = np.argsort(np.random.RandomState(42).permutation(500))
    places = spark.createDataFrame([(i, int(p)) for i, p in enumerate(place)], "row int, place int")
    return X.house_features(indexed.join(places, "row")).cache()


def fitted(train, kind):
    prepare = E.column_transformer(train, NUMERIC, CATEGORICAL)
    model = M.fit_linear(prepare.transform(train), "price", kind=kind, alpha=ALPHA[kind])
    return prepare, model


@pytest.mark.parametrize("kind", list(RECORDED))
def test_recorded_results(houses, kind):
    test, train = houses.where("place < 100"), houses.where("place >= 100").cache()
    prepare, model = fitted(train, kind)
    scored = model.transform(prepare.transform(test))
    r = V.regression_metrics(scored, "price", "prediction").first()
    m = V.mape(scored, "price", "prediction").first()["mape"]
    rel = 1e-5 if kind == "lasso" else 1e-7
    rmse, mae, mape, r2, cv_mean, cv_std = RECORDED[kind]
    assert (r["rmse"], r["mae"], m) == (pytest.approx(rmse, rel=rel), pytest.approx(mae, rel=rel), pytest.approx(mape, rel=rel))
    assert r["r2"] == pytest.approx(r2, rel=1e-4)
    folds = train.withColumn("fold", F.floor((F.col("place") - 100) / 80))
    parts = None
    for i in range(5):
        prep, mod = fitted(folds.where(F.col("fold") != i), kind)
        part = mod.transform(prep.transform(folds.where(F.col("fold") == i))).select("fold", "price", "prediction")
        parts = part if parts is None else parts.unionByName(part)
    s = V.summarize_folds(V.regression_metrics_by(parts, "fold", "price", "prediction"), ["r2"]).first()
    assert s["mean"] == pytest.approx(cv_mean, abs=2e-5) and s["std"] == pytest.approx(cv_std, abs=2e-5)


def test_recorded_importance(spark, houses):
    train = houses.where("place >= 100")
    prepare, model = fitted(train, "elasticnet")
    top = I.importance_coef(spark, model, E.output_names(prepare, NUMERIC, CATEGORICAL)).limit(3).collect()
    assert [r["feature"] for r in top] == ["distance_age_interaction", "distance_to_center", "rooms"]
    assert top[0]["importance"] == pytest.approx(43561.562287411645, rel=1e-5)
