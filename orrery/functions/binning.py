"""Banding of numbers by explicit edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _band(x: Column, edges: Sequence[float], labels: Sequence, inside) -> Column:
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is required")
    out = F.lit(None)
    for lo, hi, name in reversed(list(zip(edges, edges[1:], labels))):
        out = F.when(inside(x, F.lit(float(lo)), F.lit(float(hi))), F.lit(name)).otherwise(out)
    # Spark orders NaN above every number, so without this it would fall in an open last band.
    return F.when(F.isnan(x.cast("double")), F.lit(None)).otherwise(out)


def cut_right(
    x: Column, edges: Sequence[float], labels: Sequence, include_lowest: bool = False
) -> Column:
    """Label of the interval `(a, b]` that holds `x`; null outside all of them."""
    banded = _band(x, edges, labels, lambda v, lo, hi: (v > lo) & (v <= hi))
    if include_lowest:
        banded = F.when(x == F.lit(float(edges[0])), F.lit(labels[0])).otherwise(banded)
    return banded


def cut_left(x: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the interval `[a, b)` that holds `x`; null outside all of them."""
    return _band(x, edges, labels, lambda v, lo, hi: (v >= lo) & (v < hi))
