"""Queries over joins, SQL, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions.binning import cut_right
from orrery.functions.numeric import safe_divide
from orrery.operators import combine as J
from orrery.plans.registry import Tables, query
from orrery.sources import tables as S
from orrery.sources.storage import work_folder

BAND_EDGES = [float("-inf"), 0.0, 0.005, 0.01, float("inf")]
BAND_LABELS = ["<=0", "0-0.005", "0.005-0.01", ">0.01"]


@query(
    """WITH s AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY 1),
    t AS (SELECT c_mktsegment, spend, round(coalesce(c_acctbal / CAST(spend AS DOUBLE), 0.0), 6) AS r
          FROM customer LEFT JOIN s ON c_custkey = o_custkey)
    SELECT c_mktsegment, CASE WHEN r <= 0 THEN '<=0' WHEN r <= 0.005 THEN '0-0.005'
           WHEN r <= 0.01 THEN '0.005-0.01' ELSE '>0.01' END AS band,
           count(*) AS n, CAST(sum(spend) AS DOUBLE) AS spend
    FROM t GROUP BY 1, 2"""
)
def segment_bands(spark, sf):
    """Customers with their spend: joined, put in ratio, banded and grouped."""
    t = Tables(spark, sf)
    spend = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend")
    )
    joined = J.left_join(t.customer, spend, "c_custkey", null_safe=False)
    ratio = F.round(safe_divide(F.col("c_acctbal"), F.col("spend"), 0), 6)
    banded = joined.withColumn("band", cut_right(ratio, BAND_EDGES, BAND_LABELS))
    return banded.groupBy("c_mktsegment", "band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("spend").cast("double").alias("spend")
    )


def _clients(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("client_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )


def _credits(t: Tables):
    return t.orders.select(
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
    )


def _money(t: Tables):
    return t.orders.groupBy(F.col("o_custkey").alias("client_id")).agg(
        F.max("o_totalprice").alias("largest"), F.count(F.lit(1)).alias("orders")
    )


@query(
    """SELECT c_custkey AS client_id, c_name AS name, c_acctbal AS amount_x, o.o_orderkey AS order_id,
    o.o_orderstatus AS status, o.o_totalprice AS amount_y, largest, orders FROM customer
    LEFT JOIN orders o ON c_custkey = o.o_custkey
    LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS largest, count(*) AS orders FROM orders GROUP BY 1) f
    ON c_custkey = f.o_custkey"""
)
def left_join_chain(spark, sf):
    t = Tables(spark, sf)
    return J.left_join_chain(_clients(t), [_credits(t), _money(t)], "client_id")


@query(
    """WITH f AS (SELECT o_custkey AS k, CAST(trunc(max(o_totalprice)) AS BIGINT) AS score, count(*) AS past_due FROM orders GROUP BY 1)
    SELECT c_custkey AS client_id, c_mktsegment AS segment, c_acctbal AS balance, o_orderkey AS order_id, o_orderstatus AS status,
    score AS credit_score, past_due FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN f ON c_custkey = k"""
)
def integrate_sources(spark, sf):
    """A CSV table, JSON arrays and an INSERT dump, read back, joined and written as CSV."""
    t = Tables(spark, sf)
    clients = t.customer.select(
        F.col("c_custkey").alias("client_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    csv = work_folder(spark, "clients")
    S.sink_csv(clients, csv)
    credit = t.orders.select(
        F.struct(
            F.col("o_custkey").alias("client_id"), F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status")
        ).alias("r"),
        F.floor(F.col("o_orderkey") / 256).alias("part"),
    )
    arrays = credit.groupBy("part").agg(F.to_json(F.collect_list("r")).alias("value"))
    money = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("m"), F.count(F.lit(1)).alias("n"))
    dump = money.select(
        F.format_string(
            "INSERT INTO financials VALUES (%s, 0.0, %s, 0.0, %s, 0.0, 0.0);",
            F.col("o_custkey").cast("double"),
            F.col("m").cast("decimal(18,2)"),
            F.col("n").cast("double"),
        ).alias("value")
    )
    sql = work_folder(spark, "dump")
    dump.write.text(sql)
    financials, _ = S.scan_insert_dump(spark, sql)
    combined = J.left_join_chain(
        S.scan_csv(spark, csv, "client_id bigint, segment string, balance double"),
        [
            S.json_array_rows(arrays, "value", "client_id: bigint, order_id: bigint, status: string"),
            financials.select("client_id", "credit_score", "past_due"),
        ],
        "client_id",
    )
    out = work_folder(spark, "combined")
    S.sink_csv(combined, out)
    return S.scan_csv(spark, out, combined.schema)


@query("""SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer""")
def scan_csv(spark, sf):
    """Read a CSV table in which `?` marks a missing balance."""
    marked = Tables(spark, sf).customer.withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("?")
    )
    path = work_folder(spark, "csv")
    S.sink_csv(marked, path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return S.scan_csv(spark, path, schema, missing="?")


@query("""SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def scan_json_array(spark, sf):
    """Events written as files of one JSON array of up to 256 records each, read back, with their JSON property."""
    e = Tables(spark, sf).events
    record = F.struct("event_id", "user_id", "event_type", "value", "props")
    arrays = e.groupBy(F.floor(F.col("event_id") / 256).alias("part")).agg(
        F.to_json(F.collect_list(record)).alias("records")
    )
    path = work_folder(spark, "json")
    arrays.write.partitionBy("part").text(path)  # a part is one row, so it is one file
    schema = "event_id bigint, user_id bigint, event_type string, value double, props string"
    rows = S.scan_json_array(spark, path, schema).drop("part")
    return rows.withColumn("k", F.from_json("props", "k bigint")["k"]).drop("props")


def _dump_lines(t: Tables):
    """One INSERT per customer; every balance below zero is written as a word."""
    return t.customer.select(
        F.concat(
            F.lit("INSERT INTO financials VALUES ("),
            F.concat_ws(
                ", ",
                F.concat(F.col("c_custkey").cast("string"), F.lit(".0")),
                F.when(F.col("c_acctbal") < 0, F.lit("'none'")).otherwise(F.col("c_acctbal").cast("string")),
                F.concat(F.lit("'"), F.col("c_nationkey").cast("string"), F.lit(".75'")),
                F.lit("10.5"),
                F.lit("2.0"),
                F.lit(" 7.25 "),
                F.lit("0"),
            ),
            F.lit(");"),
        ).alias("value")
    )


DUMP_ROWS = """SELECT c_custkey AS client_id, c_acctbal AS income, CAST(c_nationkey AS BIGINT) AS credit_score,
    CAST(10.5 AS DOUBLE) AS loan_amount, CAST(2 AS BIGINT) AS past_due, CAST(7.25 AS DOUBLE) AS monthly_expenses,
    CAST(0 AS DOUBLE) AS savings_balance FROM customer WHERE c_acctbal >= 0"""


@query(DUMP_ROWS)
def parse_insert_dump(spark, sf):
    return S.parse_insert_dump(_dump_lines(Tables(spark, sf)))[0]


@query(
    """SELECT 'INSERT INTO financials VALUES (' || c_custkey || '.0, ''none'', ''' || c_nationkey || '.75'', 10.5, 2.0,  7.25 , 0);' AS line
    FROM customer WHERE c_acctbal < 0"""
)
def parse_insert_dump_rejected(spark, sf):
    return S.parse_insert_dump(_dump_lines(Tables(spark, sf)))[1]


@query(f"SELECT past_due, count(*) AS n, round(avg(income), 4) AS income FROM ({DUMP_ROWS}) t GROUP BY 1")
def load_sql_table(spark, sf):
    """A dump file registered as a view and queried."""
    path = work_folder(spark, "dump")
    _dump_lines(Tables(spark, sf)).write.text(path)
    S.load_sql_table(spark, path, "financials")
    return spark.sql("SELECT past_due, count(*) AS n, round(avg(income), 4) AS income FROM financials GROUP BY 1")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def sink_csv(spark, sf):
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = work_folder(spark, "csv")
    S.sink_csv(Tables(spark, sf).orders.select(*cols), path)
    return S.scan_csv(
        spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    )


def page_rows(t: Tables):
    """Conversations as paged documents: a turn is a page, counted from 1."""
    return t.conversations.select(
        F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("page_no"), "text"
    )


@query(
    """SELECT conv_id AS doc_id, count(*) AS n_pages, string_agg(text, chr(10) ORDER BY turn) AS text
    FROM conversations GROUP BY 1"""
)
def text_pages(spark, sf):
    return S.join_pages(page_rows(Tables(spark, sf)), "doc_id", "page_no", "text")


@query(
    """SELECT conv_id AS doc_id, turn + 1 AS page_no, '--- Page ' || (turn + 1) || ' ---' || chr(10) || text || chr(10) || chr(10) AS block,
    count(*) OVER (PARTITION BY conv_id) AS total_pages FROM conversations QUALIFY turn + 1 <= 20"""
)
def page_dump(spark, sf):
    return S.page_dump(page_rows(Tables(spark, sf)), "doc_id", "page_no", "text")


def _view(spark, sf):
    Tables(spark, sf).customer.createOrReplaceTempView("clients")


@query(
    """SELECT c_mktsegment AS segment, count(*) AS n, round(avg(c_acctbal), 4) AS balance FROM customer
    WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer) GROUP BY 1 HAVING count(*) > 1"""
)
def sql_select_guard(spark, sf):
    _view(spark, sf)
    return J.sql_select(
        spark,
        """  select c_mktsegment AS segment, count(*) AS n, round(avg(c_acctbal), 4) AS balance FROM clients
        WHERE c_acctbal > (SELECT avg(c_acctbal) FROM clients) GROUP BY c_mktsegment HAVING count(*) > 1""",
    )


@query(f"SELECT '{J.ONLY_SELECT}' AS error, count(*) AS n FROM customer")
def sql_select_rejected(spark, sf):
    """A statement that is no SELECT returns the refusal; the table stays as it was."""
    _view(spark, sf)
    refusal = J.sql_select(spark, "WITH c AS (SELECT 1) SELECT * FROM clients")
    n = spark.table("clients").agg(F.count(F.lit(1)).alias("n")).scalar()
    return refusal.select("error", n.alias("n"))


@query("SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def sample_rows(spark, sf):
    _view(spark, sf)
    return J.sql_select(spark, "SELECT * FROM clients ORDER BY c_custkey LIMIT 5")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def sql_topn(spark, sf):
    Tables(spark, sf).orders.createOrReplaceTempView("sales")
    return J.sql_select(spark, "SELECT o_orderkey, o_totalprice FROM sales ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'F'")
def sql_filter_project(spark, sf):
    Tables(spark, sf).orders.createOrReplaceTempView("sales")
    return J.sql_select(
        spark, "SELECT o_orderkey, o_custkey, o_totalprice FROM sales WHERE o_totalprice > 400000 AND o_orderstatus = 'F'"
    )


@query(
    """SELECT round(avg(l_quantity), 6) AS mean_quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
    count(*) AS n, max(l_discount) AS max_discount, min(l_tax) AS min_tax FROM lineitem"""
)
def sql_global_agg(spark, sf):
    Tables(spark, sf).lineitem.createOrReplaceTempView("items")
    return J.sql_select(
        spark,
        """SELECT round(avg(l_quantity), 6) AS mean_quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
        count(*) AS n, max(l_discount) AS max_discount, min(l_tax) AS min_tax FROM items""",
    )


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
    round(avg(l_discount), 8) AS mean_discount FROM lineitem GROUP BY 1, 2"""
)
def sql_group_by(spark, sf):
    Tables(spark, sf).lineitem.createOrReplaceTempView("items")
    return J.sql_select(
        spark,
        """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
        round(avg(l_discount), 8) AS mean_discount FROM items GROUP BY l_returnflag, l_linestatus""",
    )


@query(
    """WITH r AS (SELECT row_number() OVER (ORDER BY c_custkey) AS i, c_custkey, c_acctbal, c_mktsegment FROM customer),
    c AS (SELECT i, CAST(c_custkey AS VARCHAR) AS a, CAST(c_acctbal AS VARCHAR) AS b, c_mktsegment AS s FROM r)
    SELECT 1 AS line_no, 'Query Results:' AS line UNION ALL SELECT 2, repeat('-', 80)
    UNION ALL SELECT 3, 'c_custkey       | c_acctbal       | c_mktsegment   ' UNION ALL SELECT 4, repeat('-', 80)
    UNION ALL SELECT i + 4, rpad(a, greatest(15, length(a))::INT, ' ') || ' | ' || rpad(b, greatest(15, length(b))::INT, ' ') || ' | ' || rpad(s, greatest(15, length(s))::INT, ' ') FROM c
    UNION ALL SELECT count(*) + 5, repeat('-', 80) FROM c UNION ALL SELECT count(*) + 6, 'Total rows: ' || count(*) FROM c"""
)
def result_format(spark, sf):
    rows = Tables(spark, sf).customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return J.result_lines(rows, ["c_custkey"])


@query(
    """WITH g AS (SELECT c_mktsegment AS s, count(*) AS n FROM customer GROUP BY 1), r AS (SELECT row_number() OVER (ORDER BY s) AS i, * FROM g)
    SELECT 1 AS line_no, 'Query Results:' AS line UNION ALL SELECT 2, repeat('-', 80) UNION ALL SELECT 3, 's               | n              '
    UNION ALL SELECT 4, repeat('-', 80) UNION ALL SELECT i + 4, rpad(s, 15, ' ') || ' | ' || rpad(CAST(n AS VARCHAR), 15, ' ') FROM r
    UNION ALL SELECT count(*) + 5, repeat('-', 80) FROM r UNION ALL SELECT count(*) + 6, 'Total rows: ' || count(*) FROM r"""
)
def result_format_grouped(spark, sf):
    """A grouped result of `sql_select`, ordered by text."""
    _view(spark, sf)
    out = J.sql_select(spark, "SELECT c_mktsegment AS s, count(*) AS n FROM clients GROUP BY c_mktsegment", run=True)
    return J.result_lines(out, ["s"])
