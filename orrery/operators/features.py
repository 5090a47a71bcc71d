"""Derived columns. Each step is skipped when its input columns are absent."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orrery.functions.binning import cut_left, cut_right
from orrery.functions.numeric import finite, number, flag, safe_divide
from orrery.operators.clean import columns_with_missing, impute_median, missing_indicator
from orrery.operators.profile import numeric_and_categorical

INF = float("inf")

# Band edges and labels.
EMPLOYMENT_EDGES, EMPLOYMENT_LABELS = [-1, 1, 5, 10, INF], ["<1", "1-5", "5-10", "10+"]
AGE_EDGES, AGE_LABELS = [18, 25, 35, 50, 65, INF], ["18-24", "25-34", "35-49", "50-64", "65+"]
PAST_DUE_EDGES, PAST_DUE_LABELS = [-1, 0, 1, 3, 6, INF], ["0", "1", "2-3", "4-6", "6+"]
EXPENSE_EDGES = [-0.01, 0.3, 0.5, 0.7, 1.0, INF]
EXPENSE_LABELS = ["<30%", "30-50%", "50-70%", "70-100%", ">100%"]
HOUSE_AGE_EDGES, HOUSE_AGE_LABELS = [0, 5, 15, 30, 50, 100], ["0-5", "6-15", "16-30", "31-50", "51+"]


def has(df: DataFrame, *cols: str) -> bool:
    return set(cols) <= set(df.columns)


def cyclic_hour(hour: Column) -> tuple[Column, Column]:
    """Sine and cosine of the hour on a 24-hour circle."""
    angle = hour.cast("double") * (2.0 * math.pi) / 24.0
    return F.sin(angle), F.cos(angle)


def both_set(a: Column, b: Column) -> Column:
    """1 where both 0/1 flags are 1."""
    return flag((a == 1) & (b == 1))


def cut_equal_width(df: DataFrame, col: str, bins: int, out: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Codes 0..bins-1 of equal-width, right-closed bins between minimum and maximum."""
    x = finite(F.col(col))
    base = fit_on if fit_on is not None else df
    span = base.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = span["lo"], span["hi"]
    if lo is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    step, reach = (hi - lo) / bins, 0.001 * (hi - lo)
    # A constant column gets one bin around its value, in the middle of the axis.
    code = F.lit((bins - 1) // 2)
    if step:
        # The quotient may be off by one next to an edge; the edges decide.
        guess = F.least(F.greatest(F.ceil((x - lo) / step) - 1, F.lit(0)), F.lit(bins - 1))
        code = (
            F.when((guess > 0) & (x <= lo + guess * step), guess - 1)
            .when((guess < bins - 1) & (x > lo + (guess + 1) * step), guess + 1)
            .otherwise(guess)
            .cast("int")
        )
    return df.withColumn(out, F.when((x >= lo - reach) & (x <= hi), code))


def log1p_features(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add `log1p_<col>` for the columns whose minimum is not negative (one job)."""
    cols = [c for c in cols if c in df.columns]
    base = fit_on if fit_on is not None else df
    lows = base.agg(*[F.min(number(F.col(c))).alias(c) for c in cols]).first() if cols else {}
    fit = [c for c in cols if lows[c] is not None and lows[c] >= 0]
    return df.withColumns({f"log1p_{c}": F.log1p(F.col(c)) for c in fit})


def finance_ratios(df: DataFrame) -> DataFrame:
    """Income, saving and loan ratios; a quotient that cannot be formed counts as 0."""
    new: dict[str, Column] = {}
    if has(df, "income", "monthly_expenses"):
        new["disposable_income"] = F.col("income") - F.col("monthly_expenses") * 12
        if has(df, "savings_balance"):
            new["savings_rate"] = safe_divide(F.col("savings_balance"), F.col("income"), 0)
        if has(df, "loan_amount"):
            new["debt_to_income"] = safe_divide(F.col("loan_amount"), F.col("income"), 0)
    if has(df, "age", "employment_years"):
        new["years_employed_per_age"] = safe_divide(F.col("employment_years"), F.col("age") - 18, 0)
    if has(df, "income", "savings_balance"):
        new["savings_to_income"] = safe_divide(F.col("savings_balance"), F.col("income"), 0)
    if has(df, "income", "loan_amount"):
        new["loan_to_income"] = safe_divide(F.col("loan_amount"), F.col("income"), 0)
    return df.withColumns(new)


def expense_ratio_band(expenses: Column, income: Column) -> Column:
    """Band of yearly expenses over income."""
    return cut_right(safe_divide(expenses * 12, income, 0), EXPENSE_EDGES, EXPENSE_LABELS)


def category_to_string(x: Column) -> Column:
    """Text of a category; a missing one reads `nan`."""
    return F.coalesce(x.cast("string"), F.lit("nan"))


def credit_features(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Ratios, bands, flags and logs of a credit table. Bands keep the reference edges as
    they are: an age of 18 is in no band, and 0 past-due payments are in band `1`."""
    out = finance_ratios(df)
    new: dict[str, Column] = {}
    if has(df, "employment_years"):
        years = F.col("employment_years")
        new["employment_stability"] = cut_right(years, EMPLOYMENT_EDGES, EMPLOYMENT_LABELS)
        new["is_employed_stable"] = flag(years >= 2)
    if has(df, "age"):
        new["age_group"] = cut_right(F.col("age"), AGE_EDGES, AGE_LABELS)
    if has(df, "past_due"):
        new["past_due_category"] = cut_left(F.col("past_due"), PAST_DUE_EDGES, PAST_DUE_LABELS)
        new["has_past_due"] = flag(F.col("past_due") > 0)
    if has(df, "monthly_expenses", "income"):
        new["expense_ratio_category"] = expense_ratio_band(F.col("monthly_expenses"), F.col("income"))
    bands = {"employment_stability", "age_group", "past_due_category", "expense_ratio_category"}
    out = out.withColumns({n: category_to_string(c) if n in bands else c for n, c in new.items()})
    return log1p_features(out, ["income", "loan_amount", "savings_balance", "monthly_expenses"], fit_on)


def engineer_credit(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """`credit_features`, then a flag for every numeric column with gaps, then the gaps filled
    with the median. Flags and medians come from `fit_on` (default: the rows themselves)."""
    out = credit_features(df, fit_on)
    base = out if fit_on is None else credit_features(fit_on)
    numeric, _ = numeric_and_categorical(out)
    flagged = missing_indicator(out, numeric, base)
    gaps = columns_with_missing(out, numeric)
    return impute_median(flagged, gaps, base) if gaps else flagged


def house_features(df: DataFrame) -> DataFrame:
    """Interaction, square, joint flag and age band of a house table."""
    return df.withColumns(
        {
            "distance_age_interaction": F.col("distance_to_center") * F.col("age"),
            "distance_squared": F.col("distance_to_center") * F.col("distance_to_center"),
            "has_garage_and_garden": both_set(F.col("has_garage"), F.col("has_garden")),
            "age_group": cut_right(F.col("age"), HOUSE_AGE_EDGES, HOUSE_AGE_LABELS, include_lowest=True),
        }
    )
