"""Scoring of a stream with a fitted model."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from orrery.operators.models import batch_scoring


def score_stream(
    source: DataFrame, model: Model, path: str, checkpoint: str, keep: list[str], threshold: float = 0.5
) -> StreamingQuery:
    """Score the rows that have arrived and append them to a table. The row-wise transform
    needs no state; the checkpoint makes a restart go on where it stopped."""
    scored = batch_scoring(source, model, threshold).select(
        *keep, "approval_probability", "prediction", "confidence"
    )
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
