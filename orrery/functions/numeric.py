"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def finite(x: Column) -> Column:
    """`x` as a double, with NaN and the infinities turned into null."""
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def number(x: Column) -> Column:
    """`x` as a double, with NaN turned into null; infinities are values."""
    d = x.cast("double")
    return F.when(~F.isnan(d), d)


def safe_divide(x: Column, y: Column, default: float | None = None) -> Column:
    """`x / y`, or `default` where the quotient is null or not finite."""
    quotient = finite(F.try_divide(x.cast("double"), y.cast("double")))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


def truncate(x: Column, to: str = "int") -> Column:
    """Cast toward zero; values outside the target type become null."""
    return x.cast("double").try_cast(to)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.coalesce(condition, F.lit(False)).cast("int")
