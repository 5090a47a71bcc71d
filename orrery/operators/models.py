"""Models by Spark ML, with parameters translated where Spark states them differently."""

from __future__ import annotations

import itertools
import random
import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    IsotonicRegression,
    IsotonicRegressionModel,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.storagelevel import StorageLevel

from orrery.operators.evaluate import binary_metrics_by, regression_metrics_by
from orrery.sources.storage import written

# The searched parameters.
BOOSTED_GRID = {
    "maxDepth": [3, 5, 7],
    "stepSize": [0.01, 0.1, 0.3],
    "maxIter": [100, 200],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
}
LOGISTIC_GRID = {"C": [0.001, 0.01, 0.1, 1, 10, 100], "penalty": ["l1", "l2"]}
FOREST_DRAWS = {
    "numTrees": [100, 300, 500],
    "maxDepth": [4, 8, 16, 30],
    "featureSubsetStrategy": ["sqrt", "log2", "0.3"],
    "minInstancesPerNode": [1, 2, 5],
}
BOOSTED_DRAWS = {
    "maxIter": [200, 300, 400, 500],
    "maxDepth": [3, 4, 5, 6],
    "stepSize": [0.01, 0.05, 0.1],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["0.6", "0.8", "all"],
    "minInstancesPerNode": [1, 3, 5],
    "minInfoGain": [0.0, 0.1, 0.2, 0.3],
}


def fit_linear(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    kind: str = "ols",
    alpha: float = 0.0,
    l1_ratio: float = 0.5,
    max_iter: int = 200,
    tol: float = 1e-9,
) -> LinearRegressionModel:
    """OLS, lasso, ridge or elastic net with penalties on the usual scale: half the mean
    squared error plus `alpha` times the L1 norm (lasso, elastic net), or the squared error
    plus `alpha` times the squared norm (ridge).

    Spark divides the label by its deviation first, which leaves L1 as stated but scales L2."""
    y = F.col(label).cast("double")
    s = df.agg(F.stddev_pop(y).alias("sd"), F.count(y).alias("n")).first()
    sd, n = s["sd"] or 1.0, s["n"]
    if kind == "ols":
        reg, mix = 0.0, 0.0
    elif kind == "lasso":
        reg, mix = alpha, 1.0
    elif kind == "ridge":
        reg, mix = alpha * sd / n, 0.0
    elif kind == "elasticnet":
        l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio) * sd
        reg = l1 + l2
        mix = l1 / reg if reg else 0.0
    else:
        raise ValueError(f"unknown linear model {kind}")
    return LinearRegression(
        labelCol=label,
        featuresCol=features,
        regParam=reg,
        elasticNetParam=mix,
        standardization=False,
        solver="auto",  # the normal equations up to 4096 features
        maxIter=max_iter,
        tol=tol,
    ).fit(df)


def fit_logistic(
    df: DataFrame, label: str = "label", features: str = "features", C: float = 1.0, penalty: str = "l2",
    max_iter: int = 200, tol: float = 1e-9, weight: str | None = None,
):
    """Logistic regression with inverse strength `C`; the intercept is not penalized."""
    n = df.count()
    lr = LogisticRegression(
        labelCol=label,
        featuresCol=features,
        regParam=1.0 / (C * n),
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )
    return (lr.setWeightCol(weight) if weight else lr).fit(df)


def forest_regressor(label="label", features="features", trees=200, depth=10, seed=42) -> RandomForestRegressor:
    """Forest whose trees see every feature at each split."""
    return RandomForestRegressor(
        labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="all"
    )


def forest_classifier(
    label="label", features="features", trees=100, depth=10, seed=42, weight: str | None = None
) -> RandomForestClassifier:
    rf = RandomForestClassifier(
        labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt"
    )
    return rf.setWeightCol(weight) if weight else rf


def boosted_classifier(
    label="label", features="features", rounds=200, depth=5, rate=0.1, seed=42, weight: str | None = None
) -> GBTClassifier:
    """Boosted trees of the usual shape: subsampled rows and features."""
    gbt = GBTClassifier(
        labelCol=label, featuresCol=features, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed,
        subsamplingRate=0.8, featureSubsetStrategy="0.8",
    )
    return gbt.setWeightCol(weight) if weight else gbt


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Class counts, shares and the positive-class weight `n_pos / max(n_neg, 1)`."""
    pos, neg, n = F.col("positive"), F.col("negative"), F.col("total")
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positive"),
        F.count_if(F.col(label) == 0).alias("negative"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.select(
        "positive",
        "negative",
        "total",
        F.coalesce(F.try_divide(pos, n), F.lit(0.0)).alias("positive_ratio"),
        F.coalesce(F.try_divide(neg, n), F.lit(0.0)).alias("negative_ratio"),
        F.coalesce(F.try_divide(neg, pos), F.lit(float("inf"))).alias("imbalance_ratio"),
        (pos / F.greatest(neg, F.lit(1))).alias("scale_pos_weight"),
    )


def balanced_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Row weight n / (classes * rows of the class); any number of classes, null among them."""
    counts = df.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    all_ = counts.agg(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("classes")).first()
    weight = F.lit(all_["n"] or 0) / (F.lit(all_["classes"]) * F.col("__n"))
    kept = [c for c in df.columns if c != out]
    return df.join(counts, df[label].eqNullSafe(counts["__class"]), "left").select(*(df[c] for c in kept), weight.alias(out))


def positive_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Row weight of the positive class, 1 for all others."""
    scale = class_weights(df, label).first()["scale_pos_weight"]
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(scale)).otherwise(F.lit(1.0)))


def _param_maps(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def logistic_maps(estimator: LogisticRegression, n: int, grid: Mapping[str, Sequence] = LOGISTIC_GRID) -> list[dict]:
    """Parameter maps of the `C` x `penalty` grid for `n` training rows."""
    return [
        {estimator.regParam: 1.0 / (c * n), estimator.elasticNetParam: 1.0 if p == "l1" else 0.0}
        for c, p in itertools.product(grid["C"], grid["penalty"])
    ]


def drawn_maps(estimator: Estimator, space: Mapping[str, Sequence], draws: int, seed: int = 42) -> list[dict]:
    """`draws` different parameter maps from the space, by seed. They are picked by
    position, so the full grid is never built."""
    names = list(space)
    size = 1
    for name in names:
        size *= len(space[name])
    maps = []
    for at in random.Random(seed).sample(range(size), min(draws, size)):
        chosen = {}
        for name in names:
            at, i = divmod(at, len(space[name]))
            chosen[estimator.getParam(name)] = space[name][i]
        maps.append(chosen)
    return maps


def search(
    df: DataFrame,
    estimator: Estimator,
    maps: list[dict],
    fold: str,
    label: str = "label",
    metric: str = "areaUnderROC",
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validate every parameter map over given folds and refit the best on all rows.
    The folds are kept on the executors for the search, spilling to disk."""
    if metric.startswith("areaUnder"):
        evaluator = BinaryClassificationEvaluator(labelCol=label, metricName=metric, numBins=0)
    else:
        evaluator = RegressionEvaluator(labelCol=label, metricName=metric)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = kept.agg(F.max(fold)).first()[0] + 1
        return CrossValidator(
            estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol=fold,
            parallelism=parallelism,
        ).fit(kept)
    finally:
        kept.unpersist()


def grid_search(
    df: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence], fold: str, label: str = "label",
    metric: str = "areaUnderROC", parallelism: int = 4,
) -> CrossValidatorModel:
    return search(df, estimator, _param_maps(estimator, grid), fold, label, metric, parallelism)


def random_search(
    df: DataFrame, estimator: Estimator, space: Mapping[str, Sequence], draws: int, fold: str,
    label: str = "label", metric: str = "areaUnderROC", seed: int = 42, parallelism: int = 4,
) -> CrossValidatorModel:
    return search(df, estimator, drawn_maps(estimator, space, draws, seed), fold, label, metric, parallelism)


def search_results(spark, model: CrossValidatorModel) -> DataFrame:
    """One row per parameter map with its mean score; `best` marks the refitted one."""
    maps = model.getEstimatorParamMaps()
    scores = model.avgMetrics
    best = (max if model.getEvaluator().isLargerBetter() else min)(range(len(scores)), key=lambda i: scores[i])
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(s), i == best)
        for i, (m, s) in enumerate(zip(maps, scores))
    ]
    return spark.createDataFrame(rows, "candidate int, params string, score double, best boolean")


def cross_predict(df: DataFrame, estimator: Estimator, fold: str, folds: int) -> DataFrame:
    """Predictions for every row from the model that did not see its fold."""
    out = None
    for i in range(folds):
        part = estimator.fit(df.where(F.col(fold) != i)).transform(df.where(F.col(fold) == i))
        out = part if out is None else out.unionByName(part)
    return out


def cross_validate(df: DataFrame, estimator: Estimator, fold: str, label: str = "label") -> DataFrame:
    """Test metrics of a classifier per fold; `summarize_folds` gives their mean and spread.
    The rows are kept for the fits, and their scores are written once for all metrics."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = kept.agg(F.max(fold)).first()[0] + 1
        scored = positive_probability(cross_predict(kept, estimator, fold, folds))
        scores = written(scored.select(fold, label, "prediction", "score"), "scores")
    finally:
        kept.unpersist()
    return binary_metrics_by(scores, fold, label, "prediction", "score")


def staged_scores(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows `(keep..., round, score)`: the class-1 probability after each round of a boosted classifier.

    One pass: the rows get their leaf in every tree, and the leaves' shares are summed up from tree to tree. What
    the tasks need of the model is one number per leaf."""
    leaves = [
        np.array(re.findall(r"Predict: (\S+)", tree.toDebugString), dtype=float) * weight
        for tree, weight in zip(model.trees, model.treeWeights)
    ]

    @F.pandas_udf("array<double>")
    def stages(found: pd.Series) -> pd.Series:
        if not len(found):
            return pd.Series([], dtype=object)
        at = np.stack(found.to_numpy()).astype(np.int64)
        margins = np.cumsum(np.stack([share[at[:, i]] for i, share in enumerate(leaves)], axis=1), axis=1)
        return pd.Series(list(1.0 / (1.0 + np.exp(-2.0 * margins))))

    placed = model.copy().setLeafCol("__leaf").transform(df)
    scores = placed.select(*keep, F.posexplode(stages(vector_to_array("__leaf"))).alias("round", "score"))
    return scores.withColumn("round", F.col("round") + 1)


CURVES = {"logLoss": False, "areaUnderPR": True, "areaUnderROC": True}  # metric: larger is better


def validation_curve(model: Model, df: DataFrame, label: str = "label", metric: str = "logLoss") -> DataFrame:
    """Rows `(round, value)`: a metric of a boosted classifier on `df` after each of its rounds. Exact: no bins of
    scores. Null for a ranking metric where `df` has one class only; no rows for an empty `df`."""
    if metric not in CURVES:
        raise ValueError(f"unknown metric {metric}")
    scores = staged_scores(model, df.where(F.col(label).isNotNull()), [label])
    if metric == "logLoss":
        p = F.greatest(F.least("score", F.lit(1 - 1e-15)), F.lit(1e-15))
        loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))
        return scores.groupBy("round").agg(F.avg(loss).alias("value"))
    decided = written(scores.withColumn("prediction", (F.col("score") > 0.5).cast("double")), "stages")
    name = {"areaUnderPR": "average_precision", "areaUnderROC": "roc_auc"}[metric]
    return binary_metrics_by(decided, "round", label, "prediction", "score").select("round", F.col(name).alias("value"))


def stopped_round(curve: DataFrame, patience: int, larger: bool, by: Sequence[str] = ()) -> DataFrame:
    """Where boosting stops on a curve of `(round, value)`, per group of `by`: `(by..., best_round, best_value,
    last_round)`.

    It stops at the first round after `patience` rounds without a better value, or at the end; the best round is the
    first with the best value up to there. Rounds are counted as rows of the curve, whatever their numbers. Equal, null and
    NaN values are no improvement; a curve of nothing else gives its first round with a null value."""
    value = F.when(~F.isnan("value"), F.col("value") if larger else -F.col("value"))
    rounds = W.partitionBy(*by).orderBy("round")  # a curve has one row per round
    before = rounds.rowsBetween(W.unboundedPreceding, -1)
    gain = F.col("__v").isNotNull() & F.coalesce(F.col("__v") > F.max("__v").over(before), F.lit(True))
    at = F.struct(F.row_number().over(rounds).alias("i"), "round")
    marked = curve.withColumn("__v", value).withColumn("__gain", gain).withColumn("__at", at)
    best_yet = F.coalesce(F.max(F.when(F.col("__gain"), F.col("__at"))).over(rounds), F.min("__at").over(W.partitionBy(*by)))
    marked = marked.withColumn("__best", best_yet)
    past = F.count_if(F.col("__at.i") - F.col("__best.i") >= patience).over(before)
    seen = marked.withColumn("__past", F.coalesce(past, F.lit(0))).where(F.col("__past") == 0)
    last = F.max_by(F.struct("__best", "round"), "round")
    best = F.max_by(F.when(~F.isnan("value"), F.col("value")), F.when(F.col("__gain"), F.col("round")))
    return seen.groupBy(*by).agg(last.alias("__last"), best.alias("best_value")).select(
        *by, F.col("__last.__best.round").alias("best_round"), "best_value", F.col("__last.round").alias("last_round")
    )


def early_stopping(
    df: DataFrame, estimator: GBTClassifier, validation: str, patience: int = 50, metric: str = "logLoss"
) -> tuple[Model, int]:
    """Boost on the rows outside `validation`, stop after `patience` rounds without a better metric on the rows inside, and
    refit the best number of rounds on all rows."""
    label = estimator.getLabelCol()
    fitted = estimator.fit(df.where(~F.col(validation)))
    curve = validation_curve(fitted, df.where(F.col(validation)), label, metric)
    stop = stopped_round(curve, patience, CURVES[metric]).first()
    if stop is None:
        raise ValueError("no validation rows")
    return estimator.copy({estimator.maxIter: stop["best_round"]}).fit(df), stop["best_round"]


def cross_validate_linear(
    df: DataFrame, features: Sequence[str], label: str, fold: str, alpha: float = 0.0
) -> DataFrame:
    """Test metrics per fold of least squares (`alpha` 0) or ridge, fitted for all folds in one pass.

    The cross-products of the rows are summed per fold; those of a training set are the total less the fold's own, so the
    rows are read twice for any number of folds: for the sums and for the predictions. The driver gets
    (features + 2)^2 numbers a fold. Columns without spread get the coefficient 0. Rows with a null feature, label or
    fold are left out."""
    cols = [*features, label]
    rows = df.select(F.col(fold).alias("fold"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    rows = rows.dropna()
    size = len(cols) + 1
    names = [f"c{i}" for i in range(len(cols))]
    means = rows.agg(*[F.avg(c) for c in names]).first()
    if means[0] is None:
        return regression_metrics_by(rows.withColumn("p", F.lit(0.0)), "fold", names[-1], "p")
    center = np.array(means, dtype=float)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            x = np.column_stack([np.ones(len(batch)), batch[names].to_numpy(dtype=float) - center])
            for key, at in batch.groupby("fold").indices.items():
                sums[key] = sums.get(key, 0.0) + x[at].T @ x[at]
        if sums:
            yield pd.DataFrame({"fold": list(sums), "gram": [g.ravel() for g in sums.values()]})

    kind = rows.schema["fold"].dataType.simpleString()
    cells = rows.mapInPandas(products, f"fold {kind}, gram array<double>").select("fold", F.posexplode("gram").alias("at", "v"))
    grams: dict = {}
    for r in cells.groupBy("fold", "at").agg(F.sum("v").alias("v")).collect():
        grams.setdefault(r["fold"], np.zeros(size * size))[r["at"]] = r["v"]
    total = sum(grams.values())
    guess = F.lit(None).cast("double")
    for key, own in grams.items():
        g = (total - own).reshape(size, size)
        n, s = max(g[0, 0], 1.0), g[0, 1:]
        c = g[1:, 1:] - np.outer(s, s) / n
        w = np.linalg.lstsq(c[:-1, :-1] + alpha * np.eye(size - 2), c[:-1, -1], rcond=None)[0]
        start = center[-1] + s[-1] / n - w @ (center[:-1] + s[:-1] / n)
        line = sum((F.lit(float(a)) * F.col(c) for a, c in zip(w, names)), F.lit(float(start)))
        guess = F.when(F.col("fold") == key, line).otherwise(guess)
    return regression_metrics_by(rows.withColumn("p", guess), "fold", names[-1], "p")


def positive_probability(df: DataFrame, probability: str = "probability", out: str = "score") -> DataFrame:
    """The class-1 entry of a probability vector as a number."""
    return df.withColumn(out, vector_to_array(F.col(probability))[1])


def isotonic_calibration(scored: DataFrame, label: str, score: str) -> IsotonicRegressionModel:
    """Monotone map from score to probability. Equal scores are merged first, into one
    weighted row; pooling then leaves few steps per partition, and only those are merged on the driver."""
    merged = scored.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.avg(F.col(label).cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("w")
    )
    return IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w", predictionCol="calibrated").fit(merged)


def apply_calibration(df: DataFrame, model: IsotonicRegressionModel, score: str, out: str = "calibrated") -> DataFrame:
    keyed = df.withColumn("s", F.col(score).cast("double"))
    result = model.transform(keyed).drop("s")
    return result if out == "calibrated" else result.withColumnRenamed("calibrated", out)


def decide(df: DataFrame, probability: str, threshold: float | Column = 0.5) -> DataFrame:
    """Decision, approval probability and confidence in percent. Works on streams too."""
    p = F.col(probability)
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumns(
        {
            "approval_probability": p,
            "prediction": F.when(p >= cut, F.lit("Approved")).otherwise(F.lit("Rejected")),
            "confidence": F.greatest(p, 1 - p) * 100,
        }
    )


def batch_scoring(df: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Score rows with a fitted classifier and decide."""
    return decide(positive_probability(model.transform(df)), "score", threshold)
