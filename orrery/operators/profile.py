"""Profiling: summaries of columns and the data behind distribution plots."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F, types as T

from orrery.functions.numeric import finite, number
from orrery.operators.ordered import exact_quantiles, quantile_columns

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_and_categorical(
    df: DataFrame, target: str | None = None
) -> tuple[list[str], list[str]]:
    """Numeric and string columns by schema, without the target."""
    fields = [f for f in df.schema.fields if f.name != target]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def head_sample(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first `n` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def _rows(items: Sequence[Column]) -> Column:
    return F.inline(F.array(*items))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    x = {c: number(F.col(c)) for c in cols}
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(x[c]).alias("count"),
                F.avg(x[c]).alias("mean"),
                F.stddev_samp(x[c]).alias("std"),
                F.min(x[c]).alias("min"),
                F.max(x[c]).alias("max"),
            ).alias(f"c{i}")
            for i, c in enumerate(cols)
        ]
    )
    moments = one.select(_rows([F.col(f"c{i}") for i in range(len(cols))]))
    quartiles = quantile_columns(exact_quantiles(df, cols, QUARTILES.values()), QUARTILES)
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def schema_info(df: DataFrame) -> DataFrame:
    """Type and non-null count per column, with the table's row and column counts."""
    kinds = dict(df.dtypes)
    one = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    return one.select(
        _rows(
            [
                F.struct(
                    F.lit(i + 1).alias("position"),
                    F.lit(c).alias("column"),
                    F.lit(kinds[c]).alias("dtype"),
                    F.col(f"c{i}").alias("non_null"),
                    F.col("__rows").alias("n_rows"),
                    F.lit(len(df.columns)).alias("n_cols"),
                )
                for i, c in enumerate(df.columns)
            ]
        )
    )


def null_counts(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Nulls per column; `only_missing` keeps the columns that have some."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    out = one.select(
        _rows(
            [
                F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls"))
                for i, c in enumerate(df.columns)
            ]
        )
    )
    return out.where("nulls > 0") if only_missing else out


def null_mask(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(col).isNull())


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counted = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
    return counted.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def class_balance(df: DataFrame, col: str) -> DataFrame:
    """Share of each non-null value."""
    total = df.agg(F.count(F.col(col)).alias("n")).scalar()
    return value_counts(df, col).withColumn("share", F.col("n") / total)


def category_bars(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bar heights for several categorical columns in one long table."""
    long = df.select(
        _rows(
            [
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in cols
            ]
        )
    ).where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def nunique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, from one pass of distinct pairs."""
    long = df.select(
        _rows(
            [
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in cols
            ]
        )
    )
    return long.distinct().groupBy("column").agg(F.count("value").alias("n_distinct"))


def _range(df: DataFrame, x: Column) -> Row:
    """Minimum, maximum, count and deviation of an expression, from one job."""
    return df.agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("sd")
    ).first()


def _equal_width(df: DataFrame, x: Column, span: Row, bins: int) -> DataFrame:
    """Count rows per bin, bins without rows included; the last bin is closed."""
    lo, hi = (span["lo"], span["hi"]) if span["n"] else (0.0, 1.0)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    rows = df.select(x.alias("x")).where(F.col("x").isNotNull())
    value, last = F.col("x"), bins - 1
    guess = F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(last))
    # The quotient can round across an edge; the edge itself decides.
    exact = (
        F.when(value < lo + F.col("guess") * width, F.col("guess") - 1)
        .when((F.col("guess") < last) & (value >= lo + (F.col("guess") + 1) * width), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counted = rows.withColumn("guess", guess).groupBy(exact.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return axis.join(counted, "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        (F.lit(lo) + F.col("bin") * width).alias("left_edge"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _auto_bins(df: DataFrame, col: str, span: Row) -> int:
    """Bins of the narrower of the Sturges and Freedman-Diaconis widths (Sturges alone
    when the quartiles coincide)."""
    size = span["hi"] - span["lo"] if span["n"] else 0.0
    if size == 0:
        return 1
    quartiles = exact_quantiles(df, [col], [0.25, 0.75])
    iqr = quartiles.agg((F.max("value") - F.min("value")).alias("iqr")).first()["iqr"]
    sturges = size / (math.log2(span["n"]) + 1.0)
    spread = 2.0 * iqr / span["n"] ** (1.0 / 3.0)
    return math.ceil(size / (min(spread, sturges) if spread > 0 else sturges))


def histogram(df: DataFrame, col: str, bins: int | str = 30) -> DataFrame:
    """Equal-width counts; `bins="auto"` chooses the number of bins from the data."""
    x = finite(F.col(col))
    span = _range(df, x)
    return _equal_width(df, x, span, _auto_bins(df, col, span) if bins == "auto" else int(bins))


def histogram_log1p(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Histogram of `log1p(x)` when every value is positive, else of `x`."""
    raw = finite(F.col(col))
    span = _range(df, raw)
    if not span["n"] or span["lo"] <= 0:
        return _equal_width(df, raw, span, bins)
    x = F.log1p(raw)
    return _equal_width(df, x, _range(df, x), bins)


def kde_grid(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Gaussian density over `points` grid positions from minimum to maximum, with
    Scott's bandwidth. Each task adds up its kernel sums for the whole grid on the scan, so only
    `points` partial sums per task are shuffled."""
    x = finite(F.col(col))
    stats = _range(df, x)
    if not stats["n"] or not stats["sd"]:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    width = stats["sd"] * stats["n"] ** -0.2
    grid = np.linspace(stats["lo"], stats["hi"], points)
    scale = 1.0 / (stats["n"] * width * math.sqrt(2.0 * math.pi))

    def kernel_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(points)
        for batch in batches:
            values = batch["v"].to_numpy()
            for start in range(0, len(values), 4096):
                z = (grid[None, :] - values[start : start + 4096, None]) / width
                total += np.exp(-0.5 * z * z).sum(axis=0)
        yield pd.DataFrame({"point": np.arange(points), "part": total})

    parts = df.where(x.isNotNull()).select(x.alias("v")).mapInPandas(kernel_sums, "point int, part double")
    step = (stats["hi"] - stats["lo"]) / (points - 1)
    return parts.groupBy("point").agg((F.sum("part") * scale).alias("density")).select(
        "point", (F.lit(stats["lo"]) + F.col("point") * F.lit(step)).alias("x"), "density"
    )


def boxplot_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 IQR) and outlier counts."""
    quartiles = quantile_columns(exact_quantiles(df, cols, QUARTILES.values()), QUARTILES)
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    limits = quartiles.select("*", (F.col("q25") - reach).alias("lo"), (F.col("q75") + reach).alias("hi"))
    long = df.select(
        _rows([F.struct(F.lit(c).alias("column"), finite(F.col(c)).alias("x")) for c in cols])
    ).where(F.col("x").isNotNull())
    inside = F.col("x").between(F.col("lo"), F.col("hi"))
    # One limits row per listed column, so the broadcast side is bounded.
    return (
        long.join(F.broadcast(limits), "column")
        .groupBy("column", *QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def _cross_products(centre: Sequence[float]):
    """Pair counts, sums, sums of squares and of products over the rows where both columns are present: a row per pair and task."""
    c = len(centre)
    low, high = np.triu_indices(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, p = (np.zeros((c, c)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(c)]) - centre
            there = ~np.isnan(x)
            x[~there] = 0.0
            there = there.astype(float)
            n += there.T @ there
            s += x.T @ there
            q += (x * x).T @ there
            p += x.T @ x
        cells = [n[low, high], s[low, high], s.T[low, high], q[low, high], q.T[low, high], p[low, high]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(low), pa.array(high), *(pa.array(x) for x in cells)], ["i", "j", "n", "s", "t", "q", "r", "p"]
        )

    return run


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, over rows where both are present; null for a column that is constant there.

    One pass for the means, one for the cross-products of the centred columns as matrix products per Arrow batch. Each
    task sends one row per pair, whatever its number of rows."""
    cols, c = list(cols), len(cols)
    x = df.select(*[finite(F.col(name)).alias(f"x{i}") for i, name in enumerate(cols)])
    means = x.agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(c)]).first()
    kind = "i long, j long, n double, s double, t double, q double, r double, p double"
    parts = x.mapInArrow(_cross_products([m or 0.0 for m in means]), kind)
    sums = parts.groupBy("i", "j").agg(*[F.sum(v).alias(v) for v in "nstqrp"])
    n = F.col("n")
    a, b = F.col("q") - F.col("s") ** 2 / n, F.col("r") - F.col("t") ** 2 / n
    varied = (n > 1) & (a > 1e-12 * F.col("q")) & (b > 1e-12 * F.col("r"))
    corr = F.when((F.col("i") == F.col("j")) & (n > 1), 1.0).when(varied, (F.col("p") - F.col("s") * F.col("t") / n) / F.sqrt(a * b))
    found = sums.where("n > 0").select("i", "j", corr.alias("corr"))
    grid = df.sparkSession.range(c * c).select(F.floor(F.col("id") / c).alias("x"), (F.col("id") % c).alias("y"))
    names = F.array(*[F.lit(name) for name in cols])
    return grid.join(found, (F.least("x", "y") == F.col("i")) & (F.greatest("x", "y") == F.col("j")), "left").select(
        F.get(names, F.col("x").cast("int")).alias("a"), F.get(names, F.col("y").cast("int")).alias("b"), "corr"
    )


def correlated_features(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Columns to drop: those correlated at or above the threshold with an earlier one."""
    rank = F.create_map(*[F.lit(v) for i, c in enumerate(cols) for v in (c, i)])
    pairs = correlation_matrix(df, cols).where(
        (rank[F.col("a")] < rank[F.col("b")]) & (F.abs("corr") >= threshold)
    )
    return pairs.groupBy(F.col("b").alias("column")).agg(F.max(F.abs("corr")).alias("max_corr"))


def variance_inflation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation factor per column, over rows where all are present. Only the
    `cols` x `cols` matrix reaches the driver."""
    complete = df.select(*[finite(F.col(c)).alias(c) for c in cols]).na.drop()
    cells = {(r["a"], r["b"]): r["corr"] for r in correlation_matrix(complete, cols).collect()}
    matrix = np.array([[cells[a, b] for b in cols] for a in cols], dtype=float)
    factors = np.diag(np.linalg.inv(matrix))
    return df.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in zip(cols, factors)], "column string, vif double"
    )


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square statistic and degrees of freedom of two categorical columns.

    Cells without rows contribute `expected`; their sum is `n` minus the
    expected counts of the filled cells, so no empty cell is ever built."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(
        F.col(a).alias("a"), F.col(b).alias("b")
    ).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n").alias("t")).first()["t"]
    sums = {f"n{c}": F.sum("n").over(W.partitionBy(c)) for c in ("a", "b")}  # over cells, not rows
    expected = F.col("na").cast("double") * F.col("nb") / F.lit(total)
    filled = cells.withColumns(sums).withColumn("e", expected)
    gap = F.pow(F.col("n") - F.col("e"), F.lit(2.0)) / F.col("e")
    return filled.agg(
        (F.sum(gap) + (F.sum("n") - F.sum("e"))).alias("statistic"),
        ((F.countDistinct("a") - 1) * (F.countDistinct("b") - 1)).alias("dof"),
    )
