"""Feature importance tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.sources.storage import work_folder


def _table(spark: SparkSession, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    if len(names) != len(values):
        raise ValueError("one name per feature is required")
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def importance_trees(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Impurity importance of a tree ensemble, highest first."""
    return _table(spark, names, model.featureImportances.toArray())


def importance_coef(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Absolute coefficients of a linear model, highest first."""
    return _table(spark, names, [abs(v) for v in model.coefficients.toArray()])


def importance_weight(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Share of splits per feature of a tree ensemble, counted over its saved nodes."""
    path = work_folder(spark, "trees")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("nodeData.split.featureIndex").alias("i"))
    counts = nodes.where("i >= 0").groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    features = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, feature string")
    return (
        features.join(counts, "i", "left")
        .select("feature", F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0)).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def topk_features(table: DataFrame, k: int) -> DataFrame:
    """The k most important features, ties by name."""
    return table.orderBy(F.desc("importance"), "feature").limit(k)
