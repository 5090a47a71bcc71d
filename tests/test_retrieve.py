"""Retrieval against brute force."""

import numpy as np
import pytest

from orrery.operators import retrieve as R


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.RandomState(1)
    base = rng.randn(700, 8).astype(np.float32)
    base[100:130] = base[5]  # copies: equal distances
    queries = rng.randn(40, 8).astype(np.float32)
    queries[3] = base[5]
    b = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "vec_id bigint, embedding array<float>")
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    d = ((base[None].astype(float) - queries[:, None].astype(float)) ** 2).sum(-1)
    want = {i: list(np.lexsort((np.arange(700), d[i]))[:5]) for i in range(40)}
    return b, q, want, np.sqrt(d)


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("limits", [{}, {"query_bytes": 0, "block_rows": 16}, {"query_bytes": 0, "block_rows": 1000}])
def test_nearest(vectors, parts, limits):
    base, queries, want, d = vectors
    out = R.vector_topk(base.repartition(parts), queries, 5, **limits).orderBy("query_id", "rank").collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["distance"] == pytest.approx(d[r["query_id"], r["vec_id"]], abs=1e-9)
    assert got == want


def test_nearest_of_small_or_empty_sides(vectors):
    base, queries, _, _ = vectors
    assert R.vector_topk(base.limit(2), queries, 5).count() == 80
    assert R.vector_topk(base.limit(0), queries, 5).count() == 0
    assert R.vector_topk(base, queries.limit(0), 5).count() == 0


QUESTIONS = [
    (1, "II bob 3-modda nima deyiladi?", "II", "3", True, 3),
    (2, "iv  bob haqida", "IV", None, False, 5),
    (3, "12 - modda", None, "12", False, 5),
    (4, "1 bob haqida", None, None, False, 5),
    (5, "modda 7", None, None, False, 5),
    (6, "XI BOB, 5 MODDA", "XI", "5", True, 3),
]


def test_query_refs(spark):
    df = spark.createDataFrame([q[:2] for q in QUESTIONS], "q bigint, text string")
    got = R.query_refs(df, "text").orderBy("q").collect()
    assert [tuple(r) for r in got] == QUESTIONS


def docs(spark):
    rows = [(i, ["I", "ii", "XI"][i % 3], str(i % 7), [float(i), 0.0]) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id bigint, bob string, modda string, embedding array<float>")


def test_metadata_lookup(spark):
    asked = spark.createDataFrame(
        [(1, "II", "3", 3), (2, "XI", None, 5), (3, None, "6", 5), (4, None, None, 5), (5, "XX", None, 5)],
        "q bigint, chapter string, article string, k int",
    )
    out = R.metadata_lookup(asked, docs(spark), ["doc_id"]).orderBy("q", "rank").collect()
    got = {}
    for r in out:
        got.setdefault(r["q"], []).append(r["doc_id"])
    assert got == {
        1: [i for i in range(60) if i % 3 == 1 and i % 7 == 3][:3],
        2: [2, 5, 8, 11, 14],
        3: [6, 13, 20, 27, 34],
    }


def test_lookup_of_documents_without_a_chapter(spark, rows):
    some = spark.createDataFrame([(1, None, "5"), (2, "I", "5"), (3, "I", None)], "doc_id bigint, bob string, modda string")
    asked = spark.createDataFrame([(1, None, "5", 5), (2, "I", None, 5)], "q int, chapter string, article string, k int")
    out = R.metadata_lookup(asked, some, ["doc_id"]).select("q", "rank", "doc_id")
    assert rows(out) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 3)]


def test_hybrid_search_falls_back_to_vectors(spark):
    asked = spark.createDataFrame(
        [(1, "II", "3", 3, [0.0, 0.0]), (2, None, None, 5, [10.2, 0.0]), (3, "XX", "1", 3, [59.0, 0.0])],
        "q bigint, chapter string, article string, k int, embedding array<float>",
    )
    out = R.hybrid_search(asked, docs(spark), question_id="q", doc_id="doc_id").orderBy("q", "rank").collect()
    got = [(r["q"], r["doc_id"], r["found_by"]) for r in out]
    assert got[:3] == [(1, i, "metadata") for i in (10, 31, 52)]
    assert got[3:8] == [(2, i, "vector") for i in (10, 11, 9, 12, 8)]
    assert got[8:] == [(3, i, "vector") for i in (59, 58, 57)]


def test_context_and_prompt(spark):
    hits = spark.createDataFrame(
        [(1, "q?", True, 2, "I", "5", "B", "five"), (1, "q?", True, 1, "I", "4", "N/A", "four")],
        "q int, question string, specific boolean, rank int, bob string, modda string, bob_name string, page_content string",
    )
    context = R.context_build(hits, ["q", "question", "specific"])
    text = context.first()["context"]
    assert text == "[I bob 4-modda - N/A]\nfour\n\n[I bob 5-modda - B]\nfive"
    prompt = R.prompt_build(context, "question").first()["prompt"]
    assert f"Manbalar:\n{text}\n\nSavol: q?\n\nMUHIM" in prompt and prompt.endswith("Javob:")
