"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry_point

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return float(v) if v.__class__.__name__ == "Decimal" else v


def ordered(table):
    return sorted(table, key=lambda r: tuple((v is None, str(type(v).__name__ == "str"), v if v is not None else 0) for v in r))


def test_each_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
    columns = sorted(df.columns)
    got = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    assert got
    if name not in ORACLE:
        return
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = ordered([tuple(plain(r[i]) for i in places) for r in result.fetchall()])
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert x == y or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
            else:
                assert x == y


@needs_tables
def test_entry(spark):
    out = entry_point.entry(spark)
    assert out.columns == ["c_mktsegment", "band", "n", "spend"]
    assert out.count() > 0
