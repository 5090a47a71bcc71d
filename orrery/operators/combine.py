"""Joining of sources, guarded SQL and result text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.functions.text import cell_text, pad_cell
from orrery.operators.ordered import BUCKET, dense_index
from orrery.sources.storage import written


def left_join(left: DataFrame, right: DataFrame, on: str, null_safe: bool = True) -> DataFrame:
    """Left join that keeps one key column and marks other shared names `_x` and `_y`.
    With `null_safe`, missing keys match each other."""
    shared = (set(left.columns) & set(right.columns)) - {on}
    left = left.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in shared} | {on: "__key"})
    match = left[on].eqNullSafe(right["__key"]) if null_safe else left[on] == right["__key"]
    return left.join(right, match, "left").drop("__key")


def left_join_chain(first: DataFrame, others: Sequence[DataFrame], on: str, null_safe: bool = True) -> DataFrame:
    """Left joins in turn; duplicate keys on a right side multiply rows."""
    for other in others:
        first = left_join(first, other, on, null_safe)
    return first


# Reply texts.
ONLY_SELECT = "ERROR: Only SELECT queries are allowed for security reasons."
FAILED = "ERROR executing query: "
NO_ROWS = "No results found."

# Spark can call Java or start programs from inside a SELECT; a read-only query must not. The plan nodes that do.
_ESCAPES = {"CallMethodViaReflection", "TryReflect", "ScriptTransformation"}
_SUBQUERIES = {"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"}
ON_FILES = "spark.sql.runSQLOnFiles"


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _escapes(node, is_plan: bool = True) -> bool:
    """Whether an analysed plan, or an expression in it, leaves SQL; names in texts and columns do not matter."""
    kind = node.getClass().getSimpleName()
    if kind in _ESCAPES:
        return True
    if is_plan and any(_escapes(e, False) for e in _items(node.expressions())):
        return True
    if kind in _SUBQUERIES and _escapes(node.plan()):
        return True
    return any(_escapes(c, is_plan) for c in _items(node.children()))


def sql_select(spark: SparkSession, statement: str, run: bool = False) -> DataFrame:
    """Result of a SELECT over the registered views. Anything else, also a SELECT whose plan calls Java or a
    program, and a statement that does not compile, gives one row with the reason in the column `error`.
    Paths in place of views do not resolve.

    With `run` the result is a written table, and a failure while running is a reason too."""
    refused = spark.range(1).select(F.lit(ONLY_SELECT).alias("error"))
    if not statement.strip().upper().startswith("SELECT"):
        return refused
    before = spark.conf.get(ON_FILES)
    try:
        spark.conf.set(ON_FILES, "false")  # no paths in place of views
        if _escapes(spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)):
            return refused
        result = spark.sql(statement)
        if _escapes(result._jdf.queryExecution().analyzed()):
            return refused
        return written(result, "result") if run else result
    except PySparkException as e:
        return spark.range(1).select(F.lit(FAILED + str(e)).alias("error"))
    finally:
        spark.conf.set(ON_FILES, before)


def result_lines(
    df: DataFrame, order: Sequence[str], width: int = 15, title: str = "Query Results:", total: bool = True
) -> DataFrame:
    """The result as numbered text lines: title, header, padded rows and row total.
    `order` must be unique; its columns may have any type that sorts."""
    rule = "-" * 80
    kinds = dict(df.dtypes)
    row = F.concat_ws(" | ", *[pad_cell(cell_text(F.col(c), kinds[c]), width) for c in df.columns])
    # Ranges of the rows, written down because their bounds come from a sample.
    ranged = written(df.repartitionByRange(*order).withColumn(BUCKET, F.spark_partition_id()), "ranges")
    body = dense_index(ranged, order, "__i", bucket=BUCKET).select((F.col("__i") + 4).alias("line_no"), row.alias("line"))
    n = df.count()
    header = " | ".join(f"{c:{width}}" for c in df.columns)
    around = [(1, title), (2, rule), (3, header), (4, rule)] if n else [(1, NO_ROWS)]
    if n and total:
        around += [(n + 5, rule), (n + 6, f"Total rows: {n}")]
    return df.sparkSession.createDataFrame(around, "line_no bigint, line string").unionByName(body)
