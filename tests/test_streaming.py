"""Scoring of a stream equals scoring of the same rows at once."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from orrery.operators import encode as E, models as M
from orrery.streaming.scoring import score_stream


def test_stream_scores_like_batch(spark, rows, tmp_path):
    df = spark.range(200).select(
        "id", (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 2 == 0, "u").otherwise("v").alias("c"),
        ((F.col("id") % 7) > 3).cast("double").alias("label"),
    )
    prepare = E.column_transformer(df, ["x"], ["c"])
    model = PipelineModel([*prepare.stages, M.fit_logistic(prepare.transform(df))])
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    cols = ["id", "approval_probability", "prediction", "confidence"]

    def run():
        stream = spark.readStream.schema(df.schema).parquet(inbox)
        score_stream(stream, model, out, state, ["id"]).awaitTermination()
        return rows(spark.read.parquet(out).select(*cols))

    df.where("id < 120").write.parquet(inbox)
    assert run() == rows(M.batch_scoring(df.where("id < 120"), model).select(*cols))
    df.where("id >= 120").write.mode("append").parquet(inbox)
    assert run() == rows(M.batch_scoring(df, model).select(*cols))
