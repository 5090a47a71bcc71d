"""Cleaning: filters, imputation, column choice and value rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from orrery.functions.numeric import number, flag, truncate
from orrery.operators.ordered import exact_quantiles, quantile_columns


def cast_int(df: DataFrame, col: str, to: str = "int") -> DataFrame:
    return df.withColumn(col, truncate(F.col(col), to))


def filter_positive(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) > 0)


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_null_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns; names that are not there are ignored."""
    return df.drop(*cols)


def drop_category(df: DataFrame, col: str, value: str) -> DataFrame:
    """Drop the rows of one category; rows without a category stay."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def _fill(df: DataFrame, cols: Sequence[str], stats: DataFrame) -> DataFrame:
    one = stats.first()
    return df.withColumns({c: F.coalesce(number(F.col(c)), F.lit(one[c]).cast("double")) for c in cols})


def impute_mean(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill missing numbers with the column mean of `fit_on` (default `df`)."""
    base = fit_on if fit_on is not None else df
    return _fill(df, cols, base.agg(*[F.avg(number(F.col(c))).alias(c) for c in cols]))


def impute_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill missing numbers with the exact column median of `fit_on` (default `df`)."""
    base = fit_on if fit_on is not None else df
    medians = quantile_columns(exact_quantiles(base, cols, [0.5]), {"q50": 0.5})
    one = medians.agg(*[F.max(F.when(F.col("column") == c, F.col("q50"))).alias(c) for c in cols])
    return _fill(df, cols, one)


def columns_with_missing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns that have missing values, from one counting job."""
    if not cols:
        return []
    row = df.agg(*[F.count_if(number(F.col(c)).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"n{i}"]]


def missing_indicator(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add `<col>_missing` for the columns that have missing values in `fit_on` (default `df`)."""
    marked = columns_with_missing(fit_on if fit_on is not None else df, cols)
    return df.withColumns({f"{c}_missing": flag(number(F.col(c)).isNull()) for c in marked})


def feature_columns(
    df: DataFrame, target: str, allowed_targets: Sequence[str], ids: Sequence[str], leaking: Sequence[str]
) -> list[str]:
    """Columns left as features once ids, the target and target-like columns are out."""
    if target not in allowed_targets:
        raise ValueError(f"Target column must be one of {list(allowed_targets)}")
    banned = {*ids, *leaking, target}
    return [c for c in df.columns if c not in banned]


def leakage_guard(
    df: DataFrame, target: str, allowed_targets: Sequence[str], ids: Sequence[str], leaking: Sequence[str]
) -> DataFrame:
    """Keep the safe features and the target."""
    kept = feature_columns(df, target, allowed_targets, ids, leaking)
    return df.select(*kept, target)


def map_labels(df: DataFrame, col: str, mapping: Mapping[str, int], out: str) -> DataFrame:
    """Translate values by a small mapping; other values become null."""
    code = F.lit(None).cast("int")
    for value, number in mapping.items():
        code = F.when(F.col(col) == value, F.lit(number)).otherwise(code)
    return df.withColumn(out, code)


# Bounds of the scoring form, and its choices.
FORM_BOUNDS = {
    "age": (18, 100),
    "employment_years": (0, 50),
    "income": (0, 500000),
    "loan_amount": (1000, 1000000),
    "monthly_expenses": (0, 10000),
    "savings_balance": (0, 1000000),
    "past_due": (0, 12),
}
FORM_CHOICES = {
    "gender": ["Male", "Female", "Other"],
    "marital_status": ["Single", "Married", "Divorced", "Widowed"],
    "education_level": ["High School", "Bachelor's", "Master's", "PhD"],
    "region": ["North", "South", "East", "West"],
}


def range_validation(
    df: DataFrame,
    bounds: Mapping[str, tuple[float, float]] | None = None,
    choices: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows checked and rows outside the rule, per field; rules for absent columns are
    skipped. A missing value breaks its rule."""
    bounds = FORM_BOUNDS if bounds is None else bounds
    choices = FORM_CHOICES if choices is None else choices
    rules = {c: F.col(c).between(*b) for c, b in bounds.items() if c in df.columns}
    rules.update({c: F.col(c).isin(list(v)) for c, v in choices.items() if c in df.columns})
    one = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(1 - flag(ok)).alias(f"r{i}") for i, ok in enumerate(rules.values())],
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("field"), F.col("__rows").alias("checked"), F.col(f"r{i}").alias("violations")
                    )
                    for i, c in enumerate(rules)
                ]
            )
        )
    )
