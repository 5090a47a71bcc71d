"""Text functions against Python's own."""

import datetime

import pytest
from pyspark.sql import functions as F

from orrery.functions import text as X

NUMBERS = [
    0.0, -0.0, 1.0, -1.5, 1863.84, 0.001, 0.00012, 0.0001, 9.99e-5, 1.5e-5, -2e-10, 1e7, 1.2345678e7, 123456789.125,
    -98765432.1, 1e15, 123456789012345.6, 1e16, 1.5e16, -1.5e20, 1e100, 1.7976931348623157e308, 0.1 + 0.2,
]


def test_number_text(spark):
    df = spark.createDataFrame([(v,) for v in NUMBERS], "v double")
    got = [r[0] for r in df.select(X.number_text(F.col("v"))).collect()]
    assert got == [str(v) for v in NUMBERS]


def test_cell_text_of_missing_and_special(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), None), (float("-inf"), 3)], "v double, i int")
    got = [tuple(r) for r in df.select(X.cell_text(F.col("v"), "double"), X.cell_text(F.col("i"), "int")).collect()]
    assert got == [("None", "1"), ("nan", "None"), ("-inf", "3")]


@pytest.mark.parametrize("text", ["  a b\t", " x　", "\x1cq\x1f", "", " \r\n", "é ", " z​"])
def test_strip(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.strip(F.col("t"))).first()[0] == text.strip()


@pytest.mark.parametrize("name", ["a b/c", "o‘zbek-1_2", "日本!x", "½²x", "á", "٣", ""])
def test_clean_file_name(spark, name):
    df = spark.createDataFrame([(name,)], "t string")
    want = "".join(c if c.isalnum() or c in "-_" else "_" for c in name)
    assert df.select(X.clean_file_name(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("moment", [datetime.datetime(2024, 1, 2, 3, 4, 5), datetime.datetime(2024, 1, 2, 3, 4, 5, 120)])
def test_iso_time(spark, moment):
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    assert df.select(X.iso_time(F.col("t"))).first()[0] == moment.isoformat()


def test_pad_cell_keeps_long_values(spark):
    df = spark.createDataFrame([("ab",), ("abcdef",)], "t string")
    assert [r[0] for r in df.select(X.pad_cell(F.col("t"), 4)).collect()] == ["ab  ", "abcdef"]
