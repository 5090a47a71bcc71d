"""Order-dependent work without a one-task window.

A window without partition keys, or over one hot key, sorts all its rows in one
task. Here the ordered range is cut into buckets: each bucket is scanned on its own, one
total per bucket is summed up in order, and the offset is added back.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from orrery.functions.numeric import finite, number
from orrery.sources.storage import written

BUCKET = "__bucket"
MAX_BUCKETS = 8192  # about what the quantile sketch can tell apart
MOST_ROWS = 500_000  # different values that one task sorts to find a rank; ranges with more rows are cut again


def default_buckets(spark: SparkSession) -> int:
    """Buckets for one ordered range: a few per shuffle partition."""
    return min(max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), MAX_BUCKETS)


def range_bounds(
    df: DataFrame, cols: Sequence[str], buckets: int | None = None
) -> dict[str, list[float]]:
    """Cut points that split each numeric column into about equal row counts.

    One job; at most `buckets - 1` numbers per column reach the driver. They only
    balance the buckets: every result below is exact for any cut points."""
    n = buckets or default_buckets(df.sparkSession)
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    x = {c: finite(F.col(c)) for c in cols}
    cuts = [
        F.when(
            F.count(x[c]) > 0,
            F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x[c], min(max(200, 8 * n), 65535)), probs),
        ).alias(f"b{i}")
        for i, c in enumerate(cols)
    ]
    row = df.agg(*cuts).first()
    return {c: sorted(set(row[f"b{i}"] or [])) for i, c in enumerate(cols)}


def add_buckets(df: DataFrame, bounds: Mapping[str, Sequence[float]], outs: Mapping[str, str]) -> DataFrame:
    """Add the bucket number of each column in `bounds` (null stays null)."""
    cols = list(bounds)
    edge = float("inf")
    splits = [[-edge, *(bounds[c] or [0.0]), edge] for c in cols]
    for c in cols:
        df = df.withColumn(f"__cast_{outs[c]}", F.col(c).cast("double"))
    out = Bucketizer(
        splitsArray=splits,
        inputCols=[f"__cast_{outs[c]}" for c in cols],
        outputCols=[outs[c] for c in cols],
        handleInvalid="keep",
    ).transform(df)
    return out.drop(*[f"__cast_{outs[c]}" for c in cols])


def bucket_by_range(df: DataFrame, col: str, out: str = BUCKET, source: DataFrame | None = None) -> DataFrame:
    """Bucket `df` by ranges of the numeric column `col`, with cut points measured
    on `source` (default `df` itself)."""
    bounds = range_bounds(source if source is not None else df, [col])
    return add_buckets(df, bounds, {col: out})


def bucket_by_sort(df: DataFrame, order: Sequence[str], out: str = BUCKET) -> DataFrame:
    """Bucket `df` by ranges of any sortable columns: a written table whose range partitions are the buckets."""
    return written(df.repartitionByRange(*order).withColumn(out, F.spark_partition_id()), "ranges")


def running(
    df: DataFrame,
    order: Sequence[str],
    *,
    keys: Sequence[str] = (),
    bucket: str = BUCKET,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    descending: bool = False,
) -> DataFrame:
    """Running sums and last non-null values in `order`, per key.

    `bucket` must grow with `order`; rows of one key spread over its buckets, so a
    hot key is no single task. `keys` must not be null and `order` must be unique
    within a key. The window over bucket totals sees one row per bucket; without keys there must
    be few buckets, as `bucket_by_range` makes them."""
    sums, lasts = dict(sums or {}), dict(lasts or {})
    part = [*keys, bucket]

    def sort(names: Sequence[str]) -> list[Column]:
        return [F.desc(c) if descending else F.asc(c) for c in names]

    inside = W.partitionBy(*part).orderBy(*sort(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = df.select(
        "*",
        *[F.sum(e).over(inside).alias(f"__s_{n}") for n, e in sums.items()],
        *[F.last(e, ignorenulls=True).over(inside).alias(f"__l_{n}") for n, e in lasts.items()],
    )
    pick = F.min_by if descending else F.max_by
    totals = df.groupBy(*part).agg(
        *[F.sum(e).alias(f"__ts_{n}") for n, e in sums.items()],
        *[
            pick(e, F.when(e.isNotNull(), F.struct(*order))).alias(f"__tl_{n}")
            for n, e in lasts.items()
        ],
    )
    before = W.partitionBy(*keys).orderBy(*sort([bucket])).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *part,
        *[F.coalesce(F.sum(f"__ts_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
        *[F.last(f"__tl_{n}", ignorenulls=True).over(before).alias(f"__ol_{n}") for n in lasts],
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per bucket
    joined = local.join(offsets, part)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"__s_{n}") + F.col(f"__o_{n}")).alias(n) for n in sums],
        *[F.coalesce(f"__l_{n}", f"__ol_{n}").alias(n) for n in lasts],
    )


def dense_index(
    df: DataFrame,
    order: Sequence[str],
    out: str,
    *,
    keys: Sequence[str] = (),
    bucket: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """Number the rows 1, 2, ... in `order` (unique), per key. Without a bucket column the
    first order column must be numeric and not null; its ranges become the buckets."""
    if bucket is None:
        df = bucket_by_range(df, order[0])
    numbered = running(
        df, order, keys=keys, bucket=bucket or BUCKET, sums={out: F.lit(1)}, descending=descending
    )
    return numbered if bucket else numbered.drop(BUCKET)


class _Span(NamedTuple):
    """The values of a column from `lo` to `hi`: `n` rows, after the first `before` rows of the column."""

    col: int
    lo: float
    hi: float
    before: int
    n: int


def _cut_points(x: Column, buckets: int) -> Column:
    """Values that split a column into about equal row counts, and its ends."""
    probs = F.array(*[F.lit(i / buckets) for i in range(buckets + 1)])
    sketch = F.kll_sketch_agg_double(finite(x), min(max(200, 8 * buckets), 65535))
    return F.when(F.count(finite(x)) > 0, F.kll_sketch_get_quantile_double(sketch, probs))


def _around(cuts: Sequence[float] | None) -> list[float]:
    """Each cut point and the number right after it, so that a frequent value gets a range of its own."""
    both = {x for c in cuts or [] for x in (c, math.nextafter(c, math.inf))}
    return sorted(x for x in both if math.isfinite(x))


def _span_values(wide: DataFrame, spans: Sequence[_Span]) -> DataFrame:
    """One column `x0`, `x1`, ... per span with its values."""
    at = [(F.col(f"v{s.col}"), s) for s in spans]
    return wide.select(*[F.when(v.between(F.lit(s.lo), F.lit(s.hi)), v).alias(f"x{j}") for j, (v, s) in enumerate(at)])


def _held(spans: Sequence[_Span], wanted: Mapping[int, Sequence[int]], before: Column, n: Column) -> Column:
    """Whether one of the wanted ranks of the span `s` is among the `n` rows after `before`."""
    ranks = F.element_at(F.array(*[F.array(*[F.lit(r).cast("bigint") for r in wanted[s.col]]) for s in spans]), F.col("s") + 1)
    return F.exists(ranks, lambda r: (r >= before) & (r < before + n))


def _counted_spans(
    long: DataFrame, part: str, spans: Sequence[_Span], wanted: Mapping[int, Sequence[int]]
) -> list[_Span]:
    """The parts of the spans that hold a wanted rank: at most as many as there are ranks."""
    counts = long.groupBy("s", part).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    starts = F.element_at(F.array(*[F.lit(s.before).cast("bigint") for s in spans]), F.col("s") + 1)
    in_order = W.partitionBy("s").orderBy(part)
    placed = counts.withColumn("before", starts + F.sum("n").over(in_order) - F.col("n"))
    hits = placed.where(_held(spans, wanted, F.col("before"), F.col("n"))).collect()
    return [_Span(spans[r["s"]].col, r["lo"], r["hi"], r["before"], r["n"]) for r in hits]


def _long(df: DataFrame, spans: Sequence[_Span], extra: Sequence[str] = ()) -> DataFrame:
    rows = [
        F.struct(F.lit(j).alias("s"), F.col(f"x{j}").alias("value"), *[F.col(f"{e}{j}").alias(e) for e in extra])
        for j in range(len(spans))
    ]
    return df.select(F.inline(F.array(*rows))).where(F.col("value").isNotNull())


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], most: int = MOST_ROWS
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows `(column, prob, value)`.

    Rows are counted per value range, and only the few ranges that hold a wanted rank are kept. Those with more
    than `most` rows are cut again, until each has at most `most` or is one value; only then are values
    sorted. Cut points come with the number right after them, so each step takes values out, and a value with any
    number of rows ends as a range of its own. The built-in exact percentile keeps every distinct value of a column
    in one aggregation buffer.

    The driver gets cut points and, per column and wanted rank, one range."""
    cols, probs = list(cols), [float(p) for p in dict.fromkeys(probs)]
    buckets = default_buckets(df.sparkSession)
    # Adding zero makes one zero of the two signed ones.
    wide = df.select(*[(number(F.col(c)) + F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(cols)])
    whole = [
        F.struct(
            F.count(f"v{i}").alias("n"), F.min(f"v{i}").alias("lo"), F.max(f"v{i}").alias("hi"),
            _cut_points(F.col(f"v{i}"), buckets).alias("cuts"),
        ).alias(f"s{i}")
        for i in range(len(cols))
    ]
    sizes = list(wide.agg(*whole).first()) if cols else []
    places = {(i, p): (s["n"] - 1) * p for i, s in enumerate(sizes) for p in probs if s["n"]}
    wanted: dict[int, list[int]] = {}
    for (i, _), at in places.items():
        wanted[i] = sorted({*wanted.get(i, []), math.floor(at), math.ceil(at)})

    spans = [(_Span(i, s["lo"], s["hi"], 0, s["n"]), s["cuts"]) for i, s in enumerate(sizes) if i in wanted]
    ready: list[_Span] = []
    while spans:
        large = [(s, c) for s, c in spans if s.n > most and s.lo < s.hi]
        ready += [s for s, _ in spans if s.n <= most or s.lo == s.hi]
        if not large:
            break
        open_ = [s for s, _ in large]
        marked = add_buckets(
            _span_values(wide, open_),
            {f"x{j}": _around(c) for j, (_, c) in enumerate(large)},
            {f"x{j}": f"part{j}" for j in range(len(large))},
        )
        found = _counted_spans(_long(marked, open_, ["part"]), "part", open_, wanted)
        again = [s for s in found if s.n > most and s.lo < s.hi]
        row = _span_values(wide, again).agg(*[_cut_points(F.col(f"x{j}"), buckets) for j in range(len(again))]).first() if again else []
        cuts = dict(zip(again, row))
        spans = [(s, cuts.get(s)) for s in found]

    ends = [s for s in ready if s.lo == s.hi]
    rest = [s for s in ready if s.lo < s.hi]
    if rest:
        ends += _counted_spans(_long(_span_values(wide, rest), rest), "value", rest, wanted)
    at_rank = {(s.col, r): s.lo for s in ends for r in wanted[s.col] if s.before <= r < s.before + s.n}

    def between(i: int, at: float) -> float:
        low, high = at_rank[i, math.floor(at)], at_rank[i, math.ceil(at)]
        return low if low == high else low + (high - low) * (at - math.floor(at))  # also for infinities

    rows = [(cols[i], p, between(i, at)) for (i, p), at in places.items()]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], k: int = 4096) -> DataFrame:
    """Quantiles from one pass with a sketch, without interpolation: rows `(column, prob,
    value)`. The rank of a value is off by a share of about `2.3 / k ** 0.9`."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    one = df.agg(
        *[
            F.when(
                F.count(number(F.col(c))) > 0,
                F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(number(F.col(c)), k), wanted),
            ).alias(f"q{i}")
            for i, c in enumerate(cols)
        ]
    )
    rows = [F.struct(F.lit(c).alias("column"), wanted.alias("probs"), F.col(f"q{i}").alias("values")) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows))).select(
        "column", F.inline(F.arrays_zip("probs", "values")).alias("prob", "value")
    ).where("value IS NOT NULL")


def quantile_columns(quantiles: DataFrame, named: Mapping[str, float]) -> DataFrame:
    """One row per column with one field per named probability."""
    return quantiles.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(n) for n, p in named.items()]
    )
