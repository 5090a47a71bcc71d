"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import profile as P
from orrery.plans.registry import Tables, query, rounded

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def head_sample(spark, sf):
    return P.head_sample(Tables(spark, sf).orders, ["o_orderkey"])


@query(
    _union(
        [
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
            round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
            round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75,
            max({c}) AS max FROM lineitem"""
            for c in LINE_NUMBERS
        ]
    )
)
def describe_numeric(spark, sf):
    out = P.describe_numeric(Tables(spark, sf).lineitem, LINE_NUMBERS)
    return rounded(out, 4, "mean", "std", "q25", "q50", "q75")


@query(
    """SELECT 'balance' AS "column", count(b) AS count, min(b) AS min, round(quantile_cont(b, 0.5), 4) AS q50, isinf(max(b)) AS infinite
    FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'infinity'::DOUBLE ELSE c_acctbal END AS b FROM customer) t"""
)
def describe_infinite(spark, sf):
    """Infinities are counted and are the maximum."""
    b = F.when(F.col("c_custkey") % 10 == 0, F.lit(float("inf"))).otherwise(F.col("c_acctbal"))
    out = P.describe_numeric(Tables(spark, sf).customer.select(b.alias("balance")), ["balance"])
    return rounded(out, 4, "q50").select("column", "count", "min", "q50", (F.col("max") == float("inf")).alias("infinite"))


ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    _union(
        [
            f"""SELECT {i + 1} AS position, '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
            count(*) AS n_rows, {len(ORDER_TYPES)} AS n_cols FROM orders"""
            for i, (c, t) in enumerate(ORDER_TYPES.items())
        ]
    )
)
def schema_info(spark, sf):
    return P.schema_info(Tables(spark, sf).orders)


def with_labels(t: Tables):
    """Documents with their labels; most have none."""
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


LABELLED = "(SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@query(
    f"""SELECT "column", nulls FROM ({_union([f'''SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM {LABELLED} x'''
    for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")])}) t WHERE nulls > 0"""
)
def null_counts(spark, sf):
    return P.null_counts(with_labels(Tables(spark, sf)), only_missing=True)


@query(f"SELECT doc_id, quality IS NULL AS quality_missing FROM {LABELLED} x")
def null_mask(spark, sf):
    marked = P.null_mask(with_labels(Tables(spark, sf)), "quality", "quality_missing")
    return marked.select("doc_id", "quality_missing")


@query(
    """SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS BIGINT)
    AS duplicates FROM events"""
)
def duplicate_count(spark, sf):
    return P.duplicate_count(Tables(spark, sf).events.select("user_id", "event_type"))


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf):
    return P.value_counts(Tables(spark, sf).orders, "o_orderpriority")


@query(
    f"""SELECT quality AS value, count(*) AS n, round(count(*) / (SELECT CAST(count(quality) AS DOUBLE) FROM labels), 9) AS share
    FROM {LABELLED} x WHERE quality IS NOT NULL GROUP BY 1"""
)
def class_balance(spark, sf):
    return rounded(P.class_balance(with_labels(Tables(spark, sf)), "quality"), 9, "share")


def histogram_sql(source: str, x: str, bins: str) -> str:
    """Equal-width counts with the edges deciding, as the operator states them."""
    return f"""WITH r AS (SELECT {x} AS x FROM {source}),
    s AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM r),
    b AS (SELECT lo, hi, CAST({bins} AS INTEGER) AS bins FROM s),
    w AS (SELECT *, (hi - lo) / bins AS width FROM b),
    g AS (SELECT x, lo, width, bins, least(floor((x - lo) / (hi - lo) * bins), bins - 1) AS guess FROM r, w WHERE x IS NOT NULL),
    e AS (SELECT CAST(CASE WHEN x < lo + guess * width THEN guess - 1
          WHEN guess < bins - 1 AND x >= lo + (guess + 1) * width THEN guess + 1 ELSE guess END AS INTEGER) AS bin FROM g),
    c AS (SELECT bin, count(*) AS n FROM e GROUP BY 1),
    a AS (SELECT CAST(unnest(range(bins)) AS INTEGER) AS bin, lo, width FROM w)
    SELECT a.bin, round(lo + a.bin * width, 6) AS left_edge, round(lo + (a.bin + 1) * width, 6) AS right_edge,
    coalesce(c.n, 0) AS n FROM a LEFT JOIN c ON a.bin = c.bin"""


@query(histogram_sql("lineitem", "l_extendedprice", "30"))
def histogram(spark, sf):
    return rounded(P.histogram(Tables(spark, sf).lineitem, "l_extendedprice"), 6, "left_edge", "right_edge")


@query(
    histogram_sql(
        "orders",
        "o_totalprice",
        "ceil((hi - lo) / least(2.0 * iqr / pow(n, 1.0 / 3.0), (hi - lo) / (log2(n) + 1.0)))",
    )
)
def histogram_auto(spark, sf):
    return rounded(P.histogram(Tables(spark, sf).orders, "o_totalprice", "auto"), 6, "left_edge", "right_edge")


@query(
    histogram_sql("events", "CASE WHEN (SELECT min(value) FROM events) > 0 THEN ln(1 + value) ELSE value END", "30")
)
def histogram_log1p(spark, sf):
    return rounded(P.histogram_log1p(Tables(spark, sf).events, "value"), 6, "left_edge", "right_edge")


@query(histogram_sql("customer", "c_acctbal", "30"))
def histogram_log1p_signed(spark, sf):
    """Some balances are negative, so the values stay as they are."""
    return rounded(P.histogram_log1p(Tables(spark, sf).customer, "c_acctbal"), 6, "left_edge", "right_edge")


@query(
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
    stddev_samp(value) * pow(count(value), -0.2) AS h FROM events),
    g AS (SELECT CAST(unnest(range(200)) AS INTEGER) AS point),
    x AS (SELECT point, lo + point * ((hi - lo) / 199) AS x, h, n FROM g, s)
    SELECT point, round(x, 6) AS x, round(sum(exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
    FROM x, events GROUP BY point, x"""
)
def kde_grid(spark, sf):
    out = P.kde_grid(Tables(spark, sf).events, "value")
    return rounded(out, 9, "density").withColumn("x", F.round("x", 6))


def _box_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", round(any_value(q1), 4) AS q25, round(any_value(q2), 4) AS q50, round(any_value(q3), 4) AS q75,
    min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
    max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
    count(*) FILTER (NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM (SELECT {c} AS v FROM lineitem) a, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
    quantile_cont({c}, 0.75) AS q3 FROM lineitem) b"""


@query(_union([_box_sql(c) for c in ("l_extendedprice", "l_quantity")]))
def boxplot_stats(spark, sf):
    out = P.boxplot_stats(Tables(spark, sf).lineitem, ["l_extendedprice", "l_quantity"])
    return rounded(out, 4, "q25", "q50", "q75")


LINE_FLAGS = ["l_returnflag", "l_linestatus", "l_linenumber"]


@query(
    _union(
        [
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 2"""
            for c in LINE_FLAGS
        ]
    )
)
def category_bars(spark, sf):
    return P.category_bars(Tables(spark, sf).lineitem, LINE_FLAGS)


@query(
    _union(
        [
            f"SELECT '{a}' AS a, '{b}' AS b, round({'1.0' if a == b else f'corr({a}, {b})'}, 8) AS corr FROM lineitem"
            + (" GROUP BY 1, 2" if a == b else "")
            for a in LINE_NUMBERS
            for b in LINE_NUMBERS
        ]
    )
)
def correlation_matrix(spark, sf):
    return rounded(P.correlation_matrix(Tables(spark, sf).lineitem, LINE_NUMBERS), 8, "corr")


PAIRS = [("n_chars", "quality"), ("n_chars", "toxic"), ("quality", "toxic")]


@query(
    _union(
        [f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM {LABELLED} x" for a, b in PAIRS]
    )
)
def correlation_pairwise(spark, sf):
    """Labels are missing for most documents: each pair uses the rows that have both."""
    out = P.correlation_matrix(with_labels(Tables(spark, sf)), ["n_chars", "quality", "toxic"])
    return rounded(out.where("a < b AND a <> 'toxic' OR a = 'quality' AND b = 'toxic'"), 8, "corr")


CUSTOMER_COLUMNS = ["c_custkey", "c_nationkey", "c_mktsegment"]


@query(
    _union(
        [f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM customer""" for c in CUSTOMER_COLUMNS]
    )
)
def nunique(spark, sf):
    return P.nunique(Tables(spark, sf).customer, CUSTOMER_COLUMNS)


# Optional checks between features.
FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    """SELECT 'net' AS "column", round(abs(corr(l_extendedprice, l_extendedprice * (1 - l_discount))), 8) AS max_corr
    FROM lineitem HAVING abs(corr(l_extendedprice, l_extendedprice * (1 - l_discount))) >= 0.8"""
)
def corr_drop(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = Tables(spark, sf).lineitem.withColumn("net", net)
    return rounded(P.correlated_features(rows, [*FEATURES, "net"]), 8, "max_corr")


def _vif_sql(y: str, a: str, b: str) -> str:
    return f"""SELECT '{y}' AS "column", round(1 / (1 - (pow(corr({y}, {a}), 2) + pow(corr({y}, {b}), 2)
    - 2 * corr({y}, {a}) * corr({y}, {b}) * corr({a}, {b})) / (1 - pow(corr({a}, {b}), 2))), 6) AS vif FROM lineitem"""


@query(_union([_vif_sql(FEATURES[i], FEATURES[i - 1], FEATURES[i - 2]) for i in range(3)]))
def vif(spark, sf):
    return rounded(P.variance_inflation(Tables(spark, sf).lineitem, FEATURES), 6, "vif")


@query(
    """WITH c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY 1, 2),
    a AS (SELECT a, sum(n) AS na FROM c GROUP BY 1), b AS (SELECT b, sum(n) AS nb FROM c GROUP BY 1),
    f AS (SELECT a.a, b.b, CAST(coalesce(n, 0) AS DOUBLE) AS n, CAST(na AS DOUBLE) * nb / (SELECT sum(n) FROM c) AS e
    FROM a CROSS JOIN b LEFT JOIN c ON c.a = a.a AND c.b = b.b)
    SELECT round(sum(pow(n - e, 2) / e), 6) AS statistic,
    (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM f"""
)
def chi_square(spark, sf):
    return rounded(P.chi_square(Tables(spark, sf).orders, "o_orderstatus", "o_orderpriority"), 6, "statistic")
