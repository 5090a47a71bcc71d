"""Stages on tables of their own, and the order of the whole."""

import pytest

import corpus_pipeline as CP


@pytest.fixture
def folder(spark, tmp_path, prose_of):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose_of(900, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_take_effect(spark, docs_of, odd, prose_of, folder):
    leak, secret = prose_of(901, 200) + " " + prose_of(900, 40), prose_of(902, 100) + " password=abcdefghijkl " + prose_of(903, 20)
    rows = odd + [(20, leak), (21, secret), (22, secret.replace("password", "Password")), *[(30 + i, prose_of(910 + i, 80), f"s{i % 3}") for i in range(30)]]
    docs = docs_of(rows)
    seen = []
    for name, stage in CP.STAGES[:-1]:
        docs2 = CP.written(stage(spark, docs, folder), name)
        assert docs2.columns == docs.columns
        docs = docs2
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    quality, near, clean, safe = seen
    assert quality == {5, 6, 8, 9, None, 20, 21, 22, *range(30, 60)}
    assert near == quality - {6, 22} and clean == near - {20} and safe == clean
    assert docs.where("doc_id = 8").count() == 1  # one row of a repeated document
    assert docs.where("text LIKE '%abcdefghijkl%'").count() == 0 and docs.where("text LIKE '%[secret]%'").count() == 1
    mixed = CP.STAGES[-1][1](spark, docs, folder)
    assert mixed.columns.count("target") == 1 and {r["repeats"] for r in mixed.collect()} <= {1, 2, 3}


def test_empty_table(spark, docs_of, folder):
    docs = docs_of([])
    for _, stage in CP.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_different_texts_of_one_document_stay(spark, docs_of, prose_of, folder):
    rows = [(1, prose_of(1, 90)), (1, prose_of(2, 90)), (1, prose_of(2, 90)), (2, prose_of(1, 90)), (3, prose_of(3, 90))]
    for table in (docs_of(rows), docs_of(rows).select("doc_id", "text")):
        left = sorted((r["doc_id"], r["text"]) for r in CP.near_dedup(spark, table, folder).collect())
        assert left == sorted({rows[0], rows[1], rows[4]})
