"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions.numeric import safe_divide as divide
from orrery.operators import clean as C
from orrery.plans.profiling import LABELLED, with_labels
from orrery.plans.registry import Tables, query, rounded


@query("SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice FROM orders")
def cast_int(spark, sf):
    return C.cast_int(Tables(spark, sf).orders.select("o_orderkey", "o_totalprice"), "o_totalprice")


@query("SELECT * FROM customer WHERE c_acctbal > 0")
def filter_positive(spark, sf):
    return C.filter_positive(Tables(spark, sf).customer, "c_acctbal")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_discount FROM lineitem")
def dedup_rows(spark, sf):
    cols = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount"]
    return C.dedup_rows(Tables(spark, sf).lineitem.select(*cols))


@query(f"SELECT * FROM {LABELLED} x WHERE quality IS NOT NULL")
def drop_null_subset(spark, sf):
    return C.drop_null_subset(with_labels(Tables(spark, sf)), ["quality"])


def _gaps(t: Tables):
    """Customers whose negative balances count as missing."""
    return t.customer.select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )


GAPS = "(SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer)"


@query(
    f"""SELECT c_custkey, round(coalesce(balance, (SELECT avg(balance) FROM {GAPS} a)), 4) AS balance FROM {GAPS} x"""
)
def impute_mean(spark, sf):
    return rounded(C.impute_mean(_gaps(Tables(spark, sf)), ["balance"]), 4, "balance")


@query(
    f"""SELECT c_custkey, round(coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM {GAPS} a)), 4) AS balance
    FROM {GAPS} x"""
)
def impute_median(spark, sf):
    return rounded(C.impute_median(_gaps(Tables(spark, sf)), ["balance"]), 4, "balance")


WILD = "(SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'infinity'::DOUBLE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer)"


@query(
    f"""SELECT c_custkey, isinf(b) AS infinite, CASE WHEN NOT isinf(b) THEN round(b, 4) END AS balance FROM
    (SELECT c_custkey, coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM {WILD} a)) AS b FROM {WILD} x) t"""
)
def impute_infinite(spark, sf):
    """Infinities are values: they count for the median and stay."""
    b = F.when(F.col("c_custkey") % 10 == 0, F.lit(float("inf"))).when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    out = C.impute_median(Tables(spark, sf).customer.select("c_custkey", b.alias("balance")), ["balance"])
    infinite = F.col("balance") == float("inf")
    return out.select("c_custkey", infinite.alias("infinite"), F.when(~infinite, F.round("balance", 4)).alias("balance"))


@query("SELECT p_partkey, p_brand, p_size FROM part")
def drop_columns(spark, sf):
    return C.drop_columns(Tables(spark, sf).part, ["p_name", "p_type", "p_retailprice", "not_there"])


@query("SELECT o_orderdate, o_orderpriority, o_orderstatus FROM orders")
def leakage_guard(spark, sf):
    return C.leakage_guard(
        Tables(spark, sf).orders,
        "o_orderstatus",
        allowed_targets=["o_orderstatus", "o_orderpriority"],
        ids=["o_orderkey", "o_custkey"],
        leaking=["o_totalprice", "risk_score"],
    )


@query(
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS closed FROM orders"
)
def map_labels(spark, sf):
    mapped = C.map_labels(Tables(spark, sf).orders, "o_orderstatus", {"O": 0, "F": 1}, "closed")
    return mapped.select("o_orderkey", "closed")


@query(
    f"""SELECT doc_id, quality, toxic, CAST(quality IS NULL AS INTEGER) AS quality_missing,
    CAST(toxic IS NULL AS INTEGER) AS toxic_missing FROM {LABELLED} x"""
)
def missing_indicator(spark, sf):
    rows = with_labels(Tables(spark, sf)).select("doc_id", "quality", "toxic")
    return C.missing_indicator(rows, ["doc_id", "quality", "toxic"])


@query(
    """SELECT 'income' AS field, count(*) AS checked, count(*) FILTER (NOT c_acctbal * 40 BETWEEN 0 AND 500000) AS violations FROM customer
    UNION ALL SELECT 'savings_balance', count(*), count(*) FILTER (NOT c_acctbal BETWEEN 0 AND 1000000) FROM customer
    UNION ALL SELECT 'past_due', count(*), count(*) FILTER (NOT c_nationkey BETWEEN 0 AND 12) FROM customer
    UNION ALL SELECT 'region', count(*), count(*) FILTER (c_mktsegment NOT IN ('North', 'South', 'East', 'West')) FROM customer"""
)
def range_validation(spark, sf):
    c = Tables(spark, sf).customer
    form = c.select(
        (F.col("c_acctbal") * 40).alias("income"),
        F.col("c_acctbal").alias("savings_balance"),
        F.col("c_nationkey").alias("past_due"),
        F.col("c_mktsegment").alias("region"),
    )
    return C.range_validation(form)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax,
    round(CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice / l_tax END, 4) AS ratio FROM lineitem"""
)
def safe_divide(spark, sf):
    rows = Tables(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax"
    )
    return rows.withColumn("ratio", F.round(divide(F.col("l_extendedprice"), F.col("l_tax"), 0), 4))


@query("SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'")
def drop_category(spark, sf):
    return C.drop_category(Tables(spark, sf).customer, "c_mktsegment", "MACHINERY")
