"""A fitted model kept together with the tables that belong to it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_bundle(path: str, model: PipelineModel, tables: Mapping[str, DataFrame]) -> None:
    """Save preparation and model as one pipeline, and tables such as feature importances
    and class counts beside it."""
    model.write().save(f"{path}/model")
    for name, table in tables.items():
        table.write.parquet(f"{path}/tables/{name}")


def load_bundle(spark: SparkSession, path: str, names: list[str]) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """The model and the named tables of a saved bundle."""
    tables = {n: spark.read.parquet(f"{path}/tables/{n}") for n in names}
    return PipelineModel.load(f"{path}/model"), tables
