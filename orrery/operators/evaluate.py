"""Metrics of regression and classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from orrery.functions.numeric import flag
from orrery.operators.ordered import BUCKET, bucket_by_range, dense_index, running
from orrery.sources.storage import written


def _regression(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    mse = F.avg((y - p) * (y - p))
    return [
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))).alias("r2"),
    ]


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MSE, RMSE, MAE and R2 in one row."""
    return df.agg(*_regression(label, prediction))


def mape(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean absolute percentage error, and the rows whose label is 0 and so have none."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.agg(
        (F.avg(F.abs(F.try_divide(y - p, y))) * 100).alias("mape"), F.count_if(y == 0).alias("zero_labels")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction), with the empty cells of all seen classes."""
    filled = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # The class list of one row: labels and predictions of the counted cells.
    classes = filled.agg(
        F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("c")
    )
    grid = classes.select(F.explode("c").alias("label"), "c").select("label", F.explode("c").alias("prediction"))
    return grid.join(filled, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    cells = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Each cell counts once for its label and once for its prediction.
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").cast("string").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").cast("string").alias("class"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    per_class = sums.select(
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1_score"),
        "support",
        "hits",
    )
    scores = ["precision", "recall", "f1_score"]
    total = F.sum("support")
    accuracy = _ratio(F.sum("hits"), total)
    means = per_class.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("class"),
                *[accuracy.alias(s) for s in scores],
                total.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("class"), *[F.avg(s).alias(s) for s in scores], total.alias("support")
            ),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[_ratio(F.sum(F.col(s) * F.col("support")), total).alias(s) for s in scores],
                total.alias("support"),
            ),
        ).alias("rows")
    )
    return per_class.drop("hits").unionByName(means.select(F.inline("rows")))


def _binary(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    tp, hits = F.count_if(y & p), F.count_if(y.eqNullSafe(p))
    return [
        _ratio(hits, F.count(F.lit(1))).alias("accuracy"),
        _ratio(tp, F.count_if(p)).alias("precision"),
        _ratio(tp, F.count_if(y)).alias("recall"),
        _ratio(2 * tp, F.count_if(y) + F.count_if(p)).alias("f1_score"),
    ]


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; a quotient by zero counts as 0."""
    return df.agg(*_binary(label, prediction))


def binary_metrics_by(df: DataFrame, by: str, label: str, prediction: str, score: str) -> DataFrame:
    """The binary metrics, AUC and average precision per group, such as a fold."""
    ranked = score_counts(df, label, score, by).groupBy(by).agg(_auc(), _ap())
    return df.groupBy(by).agg(*_binary(label, prediction)).join(ranked, by, "left")


def score_counts(df: DataFrame, label: str, score: str, by: str | None = None) -> DataFrame:
    """Positives and negatives at or above each distinct score, per group of `by`. Equal
    scores are one row."""
    keys = [by] if by else []
    scored = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *keys, F.col(score).cast("double").alias("threshold"), flag(F.col(label) == 1).alias("y")
    )
    tied = scored.groupBy(*keys, "threshold").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    ranged = bucket_by_range(tied, "threshold", source=scored)
    return running(
        ranged, ["threshold"], keys=keys, sums={"tp": F.col("pos"), "fp": F.col("neg")}, descending=True
    ).drop(BUCKET)


def _class_totals(df: DataFrame, label: str, score: str) -> Row:
    """Positives and negatives with a score, from one job."""
    y = F.col(label)
    rows = df.where(F.col(score).isNotNull() & y.isNotNull())
    return rows.agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")).first()


def _share(count: Column, total: int, empty: float | None) -> Column:
    return count / F.lit(total) if total else F.lit(empty).cast("double")


def roc_curve(df: DataFrame, label: str, score: str, corners_only: bool = False) -> DataFrame:
    """False and true positive rates per distinct score, from the point (0, 0).

    `corners_only` leaves out a score when the next lower one adds as many positives and
    negatives as it did, so that the curve does not bend there."""
    t = _class_totals(df, label, score)
    counts = score_counts(df, label, score)
    if corners_only:
        counts = _corners(counts)
    points = counts.select(
        "threshold",
        _share(F.col("fp"), t["neg"], None).alias("fpr"),
        _share(F.col("tp"), t["pos"], None).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def _corners(counts: DataFrame) -> DataFrame:
    """Score rows whose successor in falling order differs in its counts, and both ends. The
    successor is found by its number, not by a window over all scores."""
    numbered = written(dense_index(counts, ["threshold"], "i", descending=True), "curve")
    following = numbered.select((F.col("i") - 1).alias("i"), F.col("pos").alias("p"), F.col("neg").alias("n"))
    bends = F.col("p").isNull() | (F.col("i") == 1) | (F.col("p") != F.col("pos")) | (F.col("n") != F.col("neg"))
    return numbered.join(following, "i", "left").where(bends).select(*counts.columns)


def _auc() -> Column:
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")


def _ap() -> Column:
    steps = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return F.coalesce(F.try_divide(steps, F.sum("pos")), F.lit(0.0)).alias("average_precision")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    return score_counts(df, label, score).agg(_auc())


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall per distinct score, to the point (1, 0) without a threshold."""
    t = _class_totals(df, label, score)
    points = score_counts(df, label, score).select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _share(F.col("tp"), t["pos"], 1.0).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision summed over the steps of recall."""
    return score_counts(df, label, score).agg(_ap())


def best_threshold(df: DataFrame, label: str, score: str, method: str = "f1") -> DataFrame:
    """The score cut with the best F1 (`f1`, `precision_recall`; the lowest of ties) or
    the best TPR - FPR (`youden`; the highest of ties). Other names give 0.5."""
    if method in ("f1", "precision_recall"):
        p, r = F.col("precision"), F.col("recall")
        f1 = 2 * (p * r) / (p + r + 1e-6)
        cuts = pr_curve(df, label, score).where("threshold IS NOT NULL").withColumn("value", f1)
        return cuts.agg(
            F.max_by("threshold", F.struct("value", -F.col("threshold"))).alias("threshold"),
            F.max("value").alias("value"),
        )
    if method == "youden":
        cuts = roc_curve(df, label, score).withColumn("value", F.col("tpr") - F.col("fpr"))
        return cuts.agg(
            F.max_by("threshold", F.struct("value", "threshold")).alias("threshold"),
            F.max("value").alias("value"),
        )
    return df.sparkSession.range(1).select(
        F.lit(0.5).alias("threshold"), F.lit(None).cast("double").alias("value")
    )


def apply_threshold(df: DataFrame, score: str, threshold: float | Column, out: str = "prediction") -> DataFrame:
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumn(out, flag(F.col(score) >= cut))


def _ranked(table: DataFrame, digits: int) -> DataFrame:
    shown = [F.round(c, digits).alias(c) for c in table.columns if c != "model"]
    best = F.row_number().over(W.orderBy(F.desc("r2"), "model")) == 1  # one row per model
    return table.select("model", *shown, best.alias("best")).orderBy(F.desc("r2"))


def model_comparison(results: Mapping[str, DataFrame], digits: int = 4) -> DataFrame:
    """One rounded row per model, the best R2 first, which is marked."""
    table = None
    for name, metrics in results.items():
        row = metrics.select(F.lit(name).alias("model"), "*")
        table = row if table is None else table.unionByName(row)
    return _ranked(table, digits)


def compare_predictions(df: DataFrame, label: str, predictions: Mapping[str, str], digits: int = 4) -> DataFrame:
    """`model_comparison` of prediction columns of one table, in one pass."""
    one = df.agg(
        *[F.struct(F.lit(m).alias("model"), *_regression(label, p)).alias(f"m{i}") for i, (m, p) in enumerate(predictions.items())]
    )
    rows = one.select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(predictions))])))
    return _ranked(rows, digits)


def pred_vs_actual(df: DataFrame, key: str, label: str, prediction: str) -> DataFrame:
    """Actual and predicted values, with the range of the identity line."""
    span = df.agg(F.min(label).alias("lo"), F.max(label).alias("hi")).first()
    return df.select(
        key,
        F.col(label).alias("actual"),
        F.col(prediction).alias("predicted"),
        F.lit(span["lo"]).alias("line_from"),
        F.lit(span["hi"]).alias("line_to"),
    )


def summarize_folds(folds: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    long = folds.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
            )
        )
    )
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("folds")
    )


def regression_metrics_by(df: DataFrame, by: str, label: str, prediction: str) -> DataFrame:
    """The regression metrics per group, such as a fold."""
    return df.groupBy(by).agg(*_regression(label, prediction))
