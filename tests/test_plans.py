"""Physical plans keep the properties that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from orrery.operators import documents as D, evaluate as V, retrieve as R, split as X

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["sql_filter_project"](spark, SF))
    assert "GreaterThan(o_totalprice,400000.0)" in text and "EqualTo(o_orderstatus,F)" in text
    assert "o_orderpriority" not in text and "o_orderdate" not in text


@pytest.mark.parametrize(
    "mark",
    [
        lambda df: X.exact_split(df, "id"),
        lambda df: X.exact_split(df, "id", by="y"),
        lambda df: X.fast_split(df, "id"),
        lambda df: X.kfold_contiguous(df, "id"),
        lambda df: X.kfold_stratified(df, "y", "id"),
        lambda df: X.kfold_stratified(df, "y", "id", seed=1),
    ],
)
def test_marking_rows_moves_none(spark, mark):
    df = spark.range(1000).withColumn("y", F.col("id") % 3)
    assert "Exchange" not in plan(mark(df)) and "Join" not in plan(mark(df))


def test_lookup_cuts_to_k_before_the_shuffle(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("I").alias("bob"), F.lit("1").alias("modda"))
    asked = spark.createDataFrame([(1, "I", "1", 3)], "q int, chapter string, article string, k int")
    text = plan(R.metadata_lookup(asked, docs, ["doc_id"]))
    below = text[text.index("WindowGroupLimit"):]
    assert "Final" in below and below.index("Exchange") < below.index("Partial")


def test_curves_have_no_window_over_all_scores(spark):
    """The only window without keys sees bucket totals: its input is grouped by bucket."""
    df = spark.range(5000).select((F.col("id") % 2).alias("y"), (F.col("id") / 7).alias("s"))
    lines = plan(V.score_counts(df, "y", "s")).split("\n")
    for i, line in enumerate(lines):
        if "Window [" in line and "SinglePartition" in "".join(lines[i : i + 4]):
            assert any("HashAggregate(keys=[__bucket" in x for x in lines[i : i + 6])


def test_articles_of_whole_documents_move_no_row(spark):
    df = spark.createDataFrame([(1, "I bob\nA\n1-modda\nx")], "doc int, text string")
    assert "Exchange" not in plan(D.articles(df, "doc", "text"))
