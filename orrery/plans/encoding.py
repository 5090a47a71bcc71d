"""Encoding, split and fold queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orrery.operators import encode as E, split as X
from orrery.operators.evaluate import regression_metrics_by, summarize_folds
from orrery.plans.registry import Tables, query, rounded
from orrery.sources.storage import written


@query(
    "SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment_code FROM customer"
)
def label_encode(spark, sf):
    rows = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    return E.label_encode(rows, "c_mktsegment", "segment_code")


@query("SELECT c_custkey, c_name, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS name_code FROM customer")
def label_encode_many(spark, sf):
    """A code per customer name, by the way that ranks very many levels in ranges."""
    rows = Tables(spark, sf).customer.select("c_custkey", "c_name")
    return E.label_encode(rows, "c_name", "name_code", small=100)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "SELECT o_orderkey, "
    + ", ".join(f"""CAST(o_orderpriority = '{p}' AS INTEGER) AS "o_orderpriority_{p}\"""" for p in PRIORITIES[1:])
    + " FROM orders"
)
def onehot_drop_first(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    return E.onehot_columns(rows, "o_orderpriority", drop_first=True).drop("o_orderpriority")


@query(
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P"
    FROM orders"""
)
def onehot_ignore_unknown(spark, sf):
    """Levels come from the orders that are not open; open ones encode as zeros."""
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    known = rows.where("o_orderstatus <> 'O'")
    return E.onehot_columns(rows, "o_orderstatus", fit_on=known).drop("o_orderstatus")


@query(
    """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment, """
    + ", ".join(f"""CAST(c_nationkey = {n} AS INTEGER) AS c_nationkey_{n}""" for n in range(1, 25))
    + " FROM customer"
)
def cardinality_encoding(spark, sf):
    """Five segments become codes, 25 nations become columns."""
    rows = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    return E.cardinality_encoding(rows, ["c_mktsegment", "c_nationkey"])


@query(
    """SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 8) AS p_size,
    round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 8) AS p_retailprice FROM part"""
)
def standard_scale(spark, sf):
    rows = Tables(spark, sf).part.select("p_partkey", "p_size", "p_retailprice")
    out = E.standard_scale(rows, ["p_size", "p_retailprice"])
    return rounded(out, 8, "p_size", "p_retailprice")


@query(
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 8) AS balance,
    CAST(c_mktsegment = 'AUTOMOBILE' AS DOUBLE) AS automobile, CAST(c_mktsegment = 'MACHINERY' AS DOUBLE) AS machinery,
    6 AS slots FROM customer"""
)
def column_transformer(spark, sf):
    rows = Tables(spark, sf).customer
    model = E.column_transformer(rows, ["c_acctbal"], ["c_mktsegment"])
    names = E.output_names(model, ["c_acctbal"], ["c_mktsegment"])
    v = vector_to_array("features")
    return model.transform(rows).select(
        "c_custkey",
        F.round(v[0], 8).alias("balance"),
        v[names.index("c_mktsegment_AUTOMOBILE")].alias("automobile"),
        v[names.index("c_mktsegment_MACHINERY")].alias("machinery"),
        F.size(v).alias("slots"),
    )


def _hash(key: str, seed: int) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 15))::BIGINT"


def split_sql(source: str, key: str, by: str, seed: int, out: str, keep: str, fraction: float = 0.2) -> str:
    """Exact split in SQL: hash order within the class, class sizes by largest remainder."""
    return f"""WITH r AS (SELECT *, {by} AS cls, {_hash(key, seed)} AS h FROM {source}),
    c AS (SELECT cls, count(*) AS n FROM r GROUP BY 1),
    t AS (SELECT sum(n) AS total, sum(n) - ceil(sum(n) * {fraction}) AS train FROM c),
    q AS (SELECT cls, n, n * train / total AS quota, floor(n * train / total) AS base FROM c, t),
    z AS (SELECT cls, n - base - CASE WHEN row_number() OVER (ORDER BY quota - base DESC, cls)
          <= (SELECT any_value(train) FROM t) - (SELECT sum(base) FROM q) THEN 1 ELSE 0 END AS n_test FROM q)
    SELECT {keep}, row_number() OVER (PARTITION BY r.cls ORDER BY h, {key}) <= n_test AS {out} FROM r JOIN z ON r.cls = z.cls"""


@query(split_sql("orders", "o_orderkey", "''", 42, "is_test", "o_orderkey"))
def train_test_split(spark, sf):
    return X.exact_split(Tables(spark, sf).orders.select("o_orderkey"), "o_orderkey")


@query(
    """SELECT o_orderkey, ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8))::BIGINT / 4294967296.0 < 0.2 AS is_test FROM orders"""
)
def train_test_split_fast(spark, sf):
    return X.fast_split(Tables(spark, sf).orders.select("o_orderkey"), "o_orderkey")


@query(split_sql("orders", "o_orderkey", "o_orderstatus", 42, "is_test", "o_orderkey, o_orderstatus"))
def stratified_split(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return X.exact_split(rows, "o_orderkey", by="o_orderstatus")


@query(split_sql("orders", "o_orderkey", "CAST(o_custkey AS VARCHAR)", 42, "is_test", "o_orderkey, o_custkey"))
def stratified_split_many(spark, sf):
    """As many classes as customers."""
    return X.exact_split(Tables(spark, sf).orders.select("o_orderkey", "o_custkey"), "o_orderkey", by="o_custkey")


@query(
    split_sql(
        f"(SELECT * FROM ({split_sql('orders', 'o_orderkey', 'o_orderstatus', 42, 'is_test', 'o_orderkey, o_orderstatus')}) a WHERE NOT is_test)",
        "o_orderkey",
        "o_orderstatus",
        43,
        "is_validation",
        "o_orderkey, o_orderstatus",
    )
)
def validation_split(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    train, _ = X.split_frames(rows, "o_orderkey", by="o_orderstatus")
    # A split reads its input several times, so the first one is written down.
    train = written(train, "train")
    return X.validation_split(train, "o_orderkey", by="o_orderstatus")


FOLD = """CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1) ELSE (n % 7) + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END"""


@query(
    f"""SELECT o_orderkey, CAST({FOLD} AS INTEGER) AS fold FROM
    (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders) t"""
)
def kfold_contiguous(spark, sf):
    return X.kfold_contiguous(Tables(spark, sf).orders.select("o_orderkey"), "o_orderkey", k=7)


def fold_sql(k: int, order: str) -> str:
    """Folds by class in SQL: the classes, in the order of their first rows, dealt one row at a time over the folds."""
    return f"""WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {order}) AS i FROM orders),
    o AS (SELECT o_orderstatus, min(o_orderkey) OVER (PARTITION BY o_orderstatus) AS first FROM orders),
    d AS (SELECT o_orderstatus, (row_number() OVER (ORDER BY first) - 1) % {k} AS fold FROM o),
    s AS (SELECT o_orderstatus, fold, count(*) AS n FROM d GROUP BY 1, 2),
    e AS (SELECT o_orderstatus, fold, sum(n) OVER (PARTITION BY o_orderstatus ORDER BY fold) AS past, n FROM s)
    SELECT r.o_orderkey, r.o_orderstatus, CAST(e.fold AS INTEGER) AS fold FROM r JOIN e ON r.o_orderstatus = e.o_orderstatus
    AND r.i > e.past - e.n AND r.i <= e.past"""


@query(fold_sql(5, "o_orderkey"))
def kfold_stratified(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return X.kfold_stratified(rows, "o_orderstatus", "o_orderkey", k=5)


@query(fold_sql(3, f"{_hash('o_orderkey', 42)}, o_orderkey"))
def kfold_stratified_shuffled(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return X.kfold_stratified(rows, "o_orderstatus", "o_orderkey", k=3, seed=42)


@query(
    """WITH f AS (SELECT l_linenumber % 5 AS fold, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem),
    m AS (SELECT fold, sqrt(avg(pow(y - p, 2))) AS rmse, avg(abs(y - p)) AS mae,
          1 - sum(pow(y - p, 2)) / (var_pop(y) * count(y)) AS r2 FROM f GROUP BY 1),
    l AS (SELECT 'rmse' AS metric, rmse AS v FROM m UNION ALL SELECT 'mae', mae FROM m UNION ALL SELECT 'r2', r2 FROM m)
    SELECT metric, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std, count(*) AS folds FROM l GROUP BY 1"""
)
def cv_metrics(spark, sf):
    rows = Tables(spark, sf).lineitem.select(
        (F.col("l_linenumber") % 5).alias("fold"),
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 1500).alias("p"),
    )
    folds = regression_metrics_by(rows, "fold", "y", "p")
    return rounded(summarize_folds(folds, ["rmse", "mae", "r2"]), 4, "mean", "std")
