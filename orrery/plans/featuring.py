"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions.binning import cut_left, cut_right
from orrery.functions.numeric import flag
from orrery.operators import features as X
from orrery.plans.profiling import LABELLED, with_labels
from orrery.plans.registry import Tables, query, rounded


@query(
    """SELECT event_id, round(sin(hour(ts) * 2 * pi() / 24), 9) AS hour_sin, round(cos(hour(ts) * 2 * pi() / 24), 9) AS hour_cos
    FROM events"""
)
def cyclic_hour(spark, sf):
    sin, cos = X.cyclic_hour(F.hour("ts"))
    return Tables(spark, sf).events.select(
        "event_id", F.round(sin, 9).alias("hour_sin"), F.round(cos, 9).alias("hour_cos")
    )


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, round(l_quantity * l_discount, 6) AS quantity_discount,
    CAST(l_returnflag = 'R' AS INTEGER) * CAST(l_linestatus = 'F' AS INTEGER) AS returned_final FROM lineitem"""
)
def interaction(spark, sf):
    return Tables(spark, sf).lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.round(F.col("l_quantity") * F.col("l_discount"), 6).alias("quantity_discount"),
        (flag(F.col("l_returnflag") == "R") * flag(F.col("l_linestatus") == "F")).alias("returned_final"),
    )


@query("SELECT p_partkey, p_size, p_size * p_size AS size_squared FROM part")
def polynomial(spark, sf):
    size = F.col("p_size")
    return Tables(spark, sf).part.select("p_partkey", "p_size", (size * size).alias("size_squared"))


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_quantity > 25 AND l_discount > 0.05 AS INTEGER) AS both_set FROM lineitem"""
)
def bool_and_flag(spark, sf):
    a, b = flag(F.col("l_quantity") > 25), flag(F.col("l_discount") > 0.05)
    return Tables(spark, sf).lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", X.both_set(a, b).alias("both_set")
    )


@query(
    """WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 4.0 AS w FROM orders)
    SELECT o_orderkey, CAST(o_totalprice > lo + w AS INTEGER) + CAST(o_totalprice > lo + 2.0 * w AS INTEGER)
    + CAST(o_totalprice > lo + 3.0 * w AS INTEGER) AS price_bin FROM orders, s"""
)
def cut_equal_width(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return X.cut_equal_width(rows, "o_totalprice", 4, "price_bin").drop("o_totalprice")


@query(
    """WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 1000.0 AS w FROM orders)
    SELECT o_orderkey, CAST(len(list_filter(range(1, 1000), lambda i: o_totalprice > lo + i * w)) AS INTEGER) AS price_bin FROM orders, s"""
)
def cut_equal_width_many(spark, sf):
    """A thousand bins."""
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return X.cut_equal_width(rows, "o_totalprice", 1000, "price_bin").drop("o_totalprice")


@query(
    """SELECT p_partkey, CASE WHEN p_size >= 0 AND p_size <= 5 THEN '0-5' WHEN p_size > 5 AND p_size <= 15 THEN '6-15'
    WHEN p_size > 15 AND p_size <= 30 THEN '16-30' WHEN p_size > 30 AND p_size <= 50 THEN '31-50'
    WHEN p_size > 50 AND p_size <= 100 THEN '51+' END AS size_band,
    CASE WHEN p_size > 18 AND p_size <= 25 THEN '18-24' WHEN p_size > 25 AND p_size <= 35 THEN '25-34'
    WHEN p_size > 35 AND p_size <= 50 THEN '35-49' WHEN p_size > 50 AND p_size <= 65 THEN '50-64'
    WHEN p_size > 65 THEN '65+' END AS age_band FROM part"""
)
def cut_edges_right(spark, sf):
    size = F.col("p_size")
    return Tables(spark, sf).part.select(
        "p_partkey",
        cut_right(size, X.HOUSE_AGE_EDGES, X.HOUSE_AGE_LABELS, include_lowest=True).alias("size_band"),
        cut_right(size, X.AGE_EDGES, X.AGE_LABELS).alias("age_band"),
    )


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber < 0 THEN '0' WHEN l_linenumber < 1 THEN '1' WHEN l_linenumber < 3 THEN '2-3'
    WHEN l_linenumber < 6 THEN '4-6' ELSE '6+' END AS band FROM lineitem"""
)
def cut_edges_left(spark, sf):
    band = cut_left(F.col("l_linenumber"), X.PAST_DUE_EDGES, X.PAST_DUE_LABELS)
    return Tables(spark, sf).lineitem.select("l_orderkey", "l_partkey", "l_linenumber", band.alias("band"))


@query(
    "SELECT c_custkey, CAST(c_acctbal > 0 AS INTEGER) AS positive, CAST(c_nationkey >= 2 AS INTEGER) AS stable FROM customer"
)
def threshold_flag(spark, sf):
    return Tables(spark, sf).customer.select(
        "c_custkey", flag(F.col("c_acctbal") > 0).alias("positive"), flag(F.col("c_nationkey") >= 2).alias("stable")
    )


@query("SELECT event_id, event_id AS shifted, value, round(ln(1 + value), 9) AS log1p_value FROM events")
def log1p_features(spark, sf):
    rows = Tables(spark, sf).events.select("event_id", F.col("event_id").alias("shifted"), "value")
    out = X.log1p_features(rows, ["value", "not_there"])
    return rounded(out, 9, "log1p_value")


def credit_rows(t: Tables):
    """A credit table derived from orders and customers: one client per customer."""
    spend = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("loan_amount"),
        F.count(F.lit(1)).alias("past_due"),
    )
    return t.customer.join(spend, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("client_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 10).otherwise(0.0).alias("income"),
        (F.col("c_nationkey") * 25.0).alias("monthly_expenses"),
        F.coalesce("loan_amount", F.lit(0.0)).alias("loan_amount"),
        F.abs("c_acctbal").alias("savings_balance"),
        F.col("c_nationkey").alias("employment_years"),
        (F.col("c_nationkey") + 18).alias("age"),
        F.coalesce("past_due", F.lit(0)).alias("past_due"),
    )


CREDIT = """(SELECT c_custkey AS client_id, CASE WHEN c_acctbal >= 0 THEN c_acctbal * 10 ELSE 0.0 END AS income,
    c_nationkey * CAST(25.0 AS DOUBLE) AS monthly_expenses, coalesce(s.loan_amount, 0.0) AS loan_amount, abs(c_acctbal) AS savings_balance,
    c_nationkey AS employment_years, c_nationkey + 18 AS age, coalesce(s.past_due, 0) AS past_due
    FROM customer LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS loan_amount,
    count(*) AS past_due FROM orders GROUP BY 1) s ON c_custkey = o_custkey)"""

_RATIO = "round(CASE WHEN {b} = 0 THEN 0.0 ELSE {a} / {b} END, 6)"


@query(
    f"""SELECT client_id, round(income - monthly_expenses * 12, 4) AS disposable_income,
    {_RATIO.format(a='savings_balance', b='income')} AS savings_rate, {_RATIO.format(a='loan_amount', b='income')} AS debt_to_income,
    round(CASE WHEN age = 18 THEN 0.0 ELSE employment_years / CAST(age - 18 AS DOUBLE) END, 6) AS years_employed_per_age,
    {_RATIO.format(a='savings_balance', b='income')} AS savings_to_income, {_RATIO.format(a='loan_amount', b='income')} AS loan_to_income
    FROM {CREDIT} c"""
)
def finance_ratios(spark, sf):
    out = X.finance_ratios(credit_rows(Tables(spark, sf)))
    ratios = ["savings_rate", "debt_to_income", "years_employed_per_age", "savings_to_income", "loan_to_income"]
    return rounded(rounded(out, 4, "disposable_income"), 6, *ratios).select(
        "client_id", "disposable_income", *ratios
    )


_EXPENSE = """CASE WHEN r > -0.01 AND r <= 0.3 THEN '<30%' WHEN r > 0.3 AND r <= 0.5 THEN '30-50%'
    WHEN r > 0.5 AND r <= 0.7 THEN '50-70%' WHEN r > 0.7 AND r <= 1.0 THEN '70-100%' WHEN r > 1.0 THEN '>100%' END"""


@query(
    f"""SELECT client_id, {_EXPENSE} AS band FROM (SELECT client_id, CASE WHEN income = 0 THEN 0.0
    ELSE monthly_expenses * 12 / income END AS r FROM {CREDIT} c) t"""
)
def expense_ratio_band(spark, sf):
    rows = credit_rows(Tables(spark, sf))
    band = X.expense_ratio_band(F.col("monthly_expenses"), F.col("income"))
    return rows.select("client_id", band.alias("band"))


@query(f"SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'nan') AS quality FROM {LABELLED} x")
def category_to_string(spark, sf):
    return with_labels(Tables(spark, sf)).select("doc_id", X.category_to_string(F.col("quality")).alias("quality"))


@query(
    f"""SELECT client_id, CASE WHEN employment_years <= 1 THEN '<1' WHEN employment_years <= 5 THEN '1-5'
    WHEN employment_years <= 10 THEN '5-10' ELSE '10+' END AS employment_stability,
    CAST(employment_years >= 2 AS INTEGER) AS is_employed_stable,
    CASE WHEN age <= 18 THEN 'nan' WHEN age <= 25 THEN '18-24' WHEN age <= 35 THEN '25-34' WHEN age <= 50 THEN '35-49'
    WHEN age <= 65 THEN '50-64' ELSE '65+' END AS age_group,
    CASE WHEN past_due < 1 THEN '1' WHEN past_due < 3 THEN '2-3' WHEN past_due < 6 THEN '4-6' ELSE '6+' END AS past_due_category,
    CAST(past_due > 0 AS INTEGER) AS has_past_due, {_EXPENSE} AS expense_ratio_category,
    round(ln(1 + income), 6) AS log1p_income, round(ln(1 + loan_amount), 6) AS log1p_loan_amount
    FROM (SELECT *, CASE WHEN income = 0 THEN 0.0 ELSE monthly_expenses * 12 / income END AS r FROM {CREDIT} c) t"""
)
def credit_features(spark, sf):
    out = X.credit_features(credit_rows(Tables(spark, sf)))
    return rounded(out, 6, "log1p_income", "log1p_loan_amount").select(
        "client_id", "employment_stability", "is_employed_stable", "age_group", "past_due_category", "has_past_due",
        "expense_ratio_category", "log1p_income", "log1p_loan_amount",
    )


_GAPS = f"(SELECT client_id, income, CASE WHEN income > 0 THEN savings_balance END AS saved FROM {CREDIT} c)"


@query(
    f"""WITH g AS (SELECT * FROM {_GAPS} t), m AS (SELECT quantile_cont(saved, 0.5) AS s, quantile_cont(ln(1 + saved), 0.5) AS l FROM g)
    SELECT client_id, round(coalesce(saved, s), 6) AS savings_balance, round(CASE WHEN saved IS NULL OR income = 0 THEN 0.0 ELSE saved / income END, 6) AS savings_rate,
    CAST(saved IS NULL AS INTEGER) AS savings_balance_missing, round(coalesce(ln(1 + saved), l), 6) AS log1p_savings_balance,
    CAST(saved IS NULL AS INTEGER) AS log1p_savings_balance_missing FROM g, m"""
)
def engineer_credit(spark, sf):
    """All steps on a credit table in which clients without income have no savings entry."""
    rows = credit_rows(Tables(spark, sf))
    gap = F.when(F.col("income") > 0, F.col("savings_balance"))
    out = X.engineer_credit(rows.withColumn("savings_balance", gap))
    shown = ["savings_balance", "savings_rate", "log1p_savings_balance"]
    return rounded(out, 6, *shown).select(
        "client_id", *shown, "savings_balance_missing", "log1p_savings_balance_missing"
    )
