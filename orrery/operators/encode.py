"""Encoding, scaling and feature assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window as W, functions as F

from orrery.functions.numeric import finite
from orrery.operators.features import category_to_string
from orrery.operators.ordered import BUCKET, default_buckets, running

SMALL_LEVELS = 100_000  # levels that may be ranked in one task and broadcast
MAX_COLUMNS = 2_000  # levels that may become columns


def _levels(df: DataFrame, col: str) -> DataFrame:
    return df.select(category_to_string(F.col(col)).alias("level")).distinct()


def level_codes(df: DataFrame, col: str, small: int = SMALL_LEVELS) -> tuple[DataFrame, bool]:
    """Levels with codes 0..k-1 in text order, and whether they are few.

    Few levels are ranked by one window; many are cut into text ranges (bounds from a hash
    sample of the levels) and ranked range by range."""
    levels = _levels(df, col)
    if levels.limit(small + 1).count() <= small:
        rank = F.row_number().over(W.orderBy("level")) - 1
        return levels.select("level", rank.alias("code")), True
    cuts = levels.orderBy(F.xxhash64("level")).limit(default_buckets(df.sparkSession) - 1).collect()
    bounds = F.array(*[F.lit(r["level"]) for r in sorted(cuts)])
    ranged = levels.withColumn(BUCKET, F.size(F.filter(bounds, lambda b: b <= F.col("level"))))
    ranked = running(ranged, ["level"], sums={"code": F.lit(1)})
    return ranked.select("level", (F.col("code") - 1).cast("int").alias("code")), False


def label_encode(
    df: DataFrame, col: str, out: str, fit_on: DataFrame | None = None, small: int = SMALL_LEVELS
) -> DataFrame:
    """Add the code of each value's rank in text order; unseen values get null."""
    codes, few = level_codes(fit_on if fit_on is not None else df, col, small)
    codes = codes.withColumnRenamed("level", "__level").withColumnRenamed("code", out)
    keyed = df.withColumn("__level", category_to_string(F.col(col)))
    return keyed.join(F.broadcast(codes) if few else codes, "__level", "left").drop("__level")


def column_levels(df: DataFrame, col: str, limit: int = MAX_COLUMNS) -> list[str]:
    """Non-null levels in text order, for use as column names."""
    rows = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("v")).distinct()
    found = [r["v"] for r in rows.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{col} has more than {limit} levels; use label_encode")
    return sorted(found)


def onehot_columns(
    df: DataFrame, col: str, drop_first: bool = False, fit_on: DataFrame | None = None
) -> DataFrame:
    """0/1 columns `col_level`; a level not seen in `fit_on` gives zeros everywhere."""
    levels = column_levels(fit_on if fit_on is not None else df, col)
    kept = levels[1:] if drop_first else levels
    text = F.col(col).cast("string")
    return df.withColumns(
        {f"{col}_{v}": F.coalesce((text == v).cast("int"), F.lit(0)) for v in kept}
    )


def cardinality_encoding(df: DataFrame, cols: Sequence[str], limit: int = 10) -> DataFrame:
    """Codes for columns with at most `limit` values, 0/1 columns (first level left out)
    for the others. The source column is replaced."""
    distinct = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in cols]).first()
    for c in cols:
        if distinct[c] <= limit:
            df = label_encode(df, c, f"{c}__code").drop(c).withColumnRenamed(f"{c}__code", c)
        else:
            df = onehot_columns(df, c, drop_first=True).drop(c)
    return df


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """`(x - mean) / std` with the population deviation of `fit_on`; a constant column
    is only centred."""
    base = fit_on if fit_on is not None else df
    x = {c: finite(F.col(c)) for c in cols}
    fields = [f for i, c in enumerate(cols) for f in (F.avg(x[c]).alias(f"m{i}"), F.stddev_pop(x[c]).alias(f"s{i}"))]
    fit = base.agg(*fields).first()
    return df.withColumns(
        {c: (x[c] - F.lit(fit[f"m{i}"])) / F.lit(fit[f"s{i}"] or 1.0) for i, c in enumerate(cols)}
    )


def column_transformer(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    *,
    scale: bool = True,
    out: str = "features",
) -> PipelineModel:
    """Fit scaling of the numeric and one-hot encoding of the categorical columns into
    one vector; all other columns pass by. Unseen and missing levels encode as zeros."""
    stages: list = []
    parts: list[str] = []
    if numeric:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="__num", handleInvalid="error"))
        parts.append("__num")
        if scale:
            # StandardScaler divides by the sample deviation; n rows turn it into the population one.
            n = df.count()
            stages.append(StandardScaler(withMean=True, withStd=True, inputCol="__num", outputCol="__std"))
            ratio = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
            stages.append(
                ElementwiseProduct(
                    scalingVec=Vectors.dense([ratio] * len(numeric)), inputCol="__std", outputCol="__scaled"
                )
            )
            parts = ["__scaled"]
    if categorical:
        codes = [f"__code_{c}" for c in categorical]
        flags = [f"__flag_{c}" for c in categorical]
        text = {c: f"__text_{c}" for c in categorical}
        stages.append(_text_copies(text))
        stages.append(
            StringIndexer(
                inputCols=list(text.values()), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages.append(OneHotEncoder(inputCols=codes, outputCols=flags, dropLast=True))
        parts += flags
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return Pipeline(stages=stages).fit(df)


def _text_copies(text: dict[str, str]) -> SQLTransformer:
    """Text copies of the categorical columns, as a stage that can be saved."""
    copies = ", ".join(f"CAST(`{c}` AS STRING) AS `{t}`" for c, t in text.items())
    return SQLTransformer(statement=f"SELECT *, {copies} FROM __THIS__")


def output_names(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """Names of the vector's slots: the numeric columns, then `col_level`."""
    names = list(numeric)
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for col, labels in zip(categorical, stage.labelsArray):
                names += [f"{col}_{level}" for level in labels]
    return names
