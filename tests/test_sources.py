"""Readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from orrery.operators import combine as J
from orrery.sources import storage, tables as S


def test_insert_dump(spark, rows, tmp_path):
    lines = [
        "CREATE TABLE financials (",
        "INSERT INTO financials VALUES (1.0, 6751.41, 773.9, 7313.6, 1.0, 3968.91, 3906.33);",
        "insert into financials values (9.0, 1, 1, 1, 1, 1, 1);",
        "INSERT INTO financials VALUES (2, '10.5' , 700, .5, 0, 1e3, 7.)",
        "INSERT INTO financials VALUES (3, 'a, b', 1, 1, 1, 1, 1);",
        "INSERT INTO financials VALUES (4, 1, 1);",
        "INSERT INTO financials VALUES (5, 1d, 1, 1, 1, 1, 1);",
        "INSERT INTO financials (broken",
        "INSERT INTO financials values (-6.7, 1, 1, 1, 1, 1, 1, 'extra');",
    ]
    path = tmp_path / "dump.sql"
    path.write_text("\n".join(lines))
    good, bad = S.scan_insert_dump(spark, str(path))
    assert rows(good) == [
        (-6, 1.0, 1, 1.0, 1, 1.0, 1.0),
        (1, 6751.41, 773, 7313.6, 1, 3968.91, 3906.33),
        (2, 10.5, 700, 0.5, 0, 1000.0, 7.0),
    ]
    assert [r[0] for r in rows(bad)] == [lines[4], lines[5], lines[6]]


def test_quoted_comma_is_one_value(spark, rows):
    df = spark.createDataFrame([("INSERT INTO t VALUES (1, 'x, y', 2);",)], "value string")
    good, _ = S.parse_insert_dump(df, fields={"a": "bigint", "b": "string", "c": "double"})
    assert rows(good) == [(1, "x, y", 2.0)]


def test_dump_as_sql_table(spark, tmp_path):
    path = tmp_path / "dump.sql"
    path.write_text("\n".join(f"INSERT INTO financials VALUES ({i}.0, {i * 10}, 700, 1, 0, 1, 1);" for i in range(5)))
    S.load_sql_table(spark, str(path), "financials")
    top = J.sql_select(spark, " select client_id, income FROM financials ORDER BY income DESC LIMIT 2")
    assert [tuple(r) for r in top.collect()] == [(4, 40.0), (3, 30.0)]


def test_csv_round_trip(spark, rows, tmp_path):
    data = [(1, 'say "hi", ok', 1.5), (2, None, None), (3, "two\nlines", -0.1)]
    df = spark.createDataFrame(data, "i int, t string, x double")
    S.sink_csv(df, str(tmp_path / "out"))
    back = S.scan_csv(spark, str(tmp_path / "out"), df.schema, line_breaks=True)
    assert rows(back) == data


def test_csv_missing_mark_and_inferred_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,?\n?,2.5\n")
    df = S.scan_csv(spark, str(path), missing="?")
    assert dict(df.dtypes) == {"a": "int", "b": "double"}
    assert [tuple(r) for r in df.collect()] == [(1, None), (None, 2.5)]


def test_json_array_file(spark, rows, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"client_id": 1, "score": 2.5}, {"client_id": 2}], indent=1))
    assert rows(S.scan_json_array(spark, str(path), "client_id bigint, score double")) == [(1, 2.5), (2, None)]


def test_pages_joined_over_blocks(spark):
    pages = spark.range(600).select(F.lit(1).alias("doc"), (F.col("id") + 1).alias("page"), F.concat(F.lit("p"), F.col("id")).alias("t"))
    row = S.join_pages(pages.repartition(5), "doc", "page", "t").first()
    assert row["t"] == "\n".join(f"p{i}" for i in range(600)) and row["n_pages"] == 600
    dump = S.page_dump(pages, "doc", "page", "t").orderBy("page").collect()
    assert len(dump) == 20 and dump[0]["block"] == "--- Page 1 ---\np0\n\n" and dump[0]["total_pages"] == 600


def test_left_join_names_and_missing_keys(spark, rows):
    a = spark.createDataFrame([(1, 5), (None, 6)], "k int, v int")
    b = spark.createDataFrame([(1, 7), (1, 8), (None, 9)], "k int, v int")
    out = J.left_join(a, b, "k")
    assert out.columns == ["k", "v_x", "v_y"]
    assert rows(out) == [(1, 5, 7), (1, 5, 8), (None, 6, 9)]
    assert rows(J.left_join(a, b, "k", null_safe=False)) == [(1, 5, 7), (1, 5, 8), (None, 6, None)]


@pytest.mark.parametrize(
    "statement",
    [
        "DROP VIEW clients", "WITH c AS (SELECT 1) SELECT * FROM c", "", "  insert into t values (1)",
        "SELECT reflect('java.lang.System', 'exit', 1)", "SELECT transform (a) using 'cat' FROM t",
    ],
)
def test_only_select(spark, statement):
    assert J.sql_select(spark, statement).first()["error"] == J.ONLY_SELECT


def test_select_that_does_not_compile(spark):
    assert J.sql_select(spark, "SELECT nothing FROM nowhere").first()["error"].startswith(J.FAILED)
    assert J.sql_select(spark, "SELECT FROM WHERE").first()["error"].startswith(J.FAILED)


def test_select_that_fails_while_running(spark):
    spark.createDataFrame([(0,), (2,)], "v int").createOrReplaceTempView("numbers")
    bad = "SELECT v, raise_error('no ' || v) AS e FROM numbers"
    assert J.sql_select(spark, bad, run=True).first()["error"].startswith(J.FAILED)
    assert J.sql_select(spark, "SELECT v FROM numbers WHERE v > 1", run=True).collect()[0]["v"] == 2


def test_result_lines(spark):
    df = spark.createDataFrame([(2, None, 10000000.0), (1, "a much longer name than the cell", 0.5)], "id int, name string, x double")
    lines = [r["line"] for r in J.result_lines(df, ["id"]).orderBy("line_no").collect()]
    cells = [("1", "a much longer name than the cell", "0.5"), ("2", "None", "10000000.0")]
    assert lines == [
        "Query Results:", "-" * 80, " | ".join(f"{c:15}" for c in df.columns), "-" * 80,
        *[" | ".join(f"{c:15}" for c in row) for row in cells], "-" * 80, "Total rows: 2",
    ]
    none = J.result_lines(df.where("id > 5"), ["id"]).collect()
    assert [r["line"] for r in none] == [J.NO_ROWS]


def test_sample_lines(spark):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    lines = J.result_lines(df, ["id"], width=12, title="Sample Data (First 5 rows):", total=False).orderBy("line_no").collect()
    assert [r["line"] for r in lines][2:] == ["id           | t           ", "-" * 80, "1            | a           "]


def test_work_folder_follows_the_setting(spark):
    assert storage.work_folder(spark, "x").startswith(spark.conf.get(storage.SETTING))


def test_metric_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for run in ("a", "b"):
        S.append_metrics(spark.range(1).select(F.lit(0.5).alias("auc")), path, run)
    assert sorted(r["run"] for r in spark.read.parquet(path).collect()) == ["a", "b"]
