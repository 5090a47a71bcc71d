"""Retrieval: references in questions, lookup by metadata, exact nearest vectors, prompts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orrery.functions.text import SPACE, preview
from orrery.sources.storage import written

# Shapes of the references, and results per question.
CHAPTER_REF = rf"(?iu)([IVXLCDM]+)[{SPACE}]+bob"
ARTICLE_REF = rf"(?iu)(\p{{Nd}}+)[{SPACE}-]*modda"
K_SPECIFIC, K_GENERAL = 3, 5

# Prompt texts around context and question.
SPECIFIC_PROMPT = (
    """Siz O'zbekiston Konstitutsiyasi bo'yicha maslahatchi botsiz. 

Savol aniq modda haqida so'rayapti. Quyida shu modda matni keltirilgan.

Manbalar:
""",
    """

Savol: """,
    """

MUHIM: Agar savol "X bob Y modda nima deyiladi?" yoki shunga o'xshash bo'lsa, manbalardan shu moddaning to'liq matnini javob sifatida bering. "Ma'lumot yo'q" deb javob bermang!

Javob:""",
)
GENERAL_PROMPT = (
    """Siz O'zbekiston Konstitutsiyasi bo'yicha maslahatchi botsiz.

Quyidagi konstitutsiya moddalaridan foydalanib savolga javob bering. 

MUHIM: 
- Agar to'g'ridan-to'g'ri javob bo'lmasa ham, eng yaqin tegishli ma'lumotni tahlil qiling
- Masalan, "yagona fuqarolik" degan ibora "faqat bitta fuqarolik" ma'nosini anglatadi
- Moddalarni diqqat bilan o'qib, mantiqiy xulosa chiqaring

Manbalar:
""",
    """

Savol: """,
    """

Javob (moddalardan mantiqiy xulosa chiqaring, agar haqiqatan ham ma'lumot bo'lmasa "Bu mavzu Konstitutsiyada keltirilmagan" deb bildiring):""",
)


def query_refs(questions: DataFrame, text: str) -> DataFrame:
    """Chapter and article number named in each question, and how many results it gets."""

    def found(pattern: str) -> Column:
        hit = F.regexp_extract(text, pattern, 1)
        return F.when(hit != "", hit)

    refs = questions.withColumns({"chapter": F.upper(found(CHAPTER_REF)), "article": found(ARTICLE_REF)})
    specific = F.col("chapter").isNotNull() & F.col("article").isNotNull()
    return refs.withColumns(
        {"specific": specific, "k": F.when(specific, F.lit(K_SPECIFIC)).otherwise(F.lit(K_GENERAL))}
    )


def _key(chapter: Column, article: Column) -> Column:
    return F.concat(F.coalesce(chapter, F.lit("")), F.lit("|"), F.coalesce(article, F.lit("")))


def metadata_lookup(
    questions: DataFrame,
    docs: DataFrame,
    order: list[str],
    chapter: str = "bob",
    article: str = "modda",
) -> DataFrame:
    """The first k documents that agree with every reference of a question.

    The first documents of each reference, as many as the largest k asked, are taken before the join, so neither
    a chapter with a third of all documents nor a popular question multiplies rows. Returns the
    question columns with `rank` and the order columns of the document."""
    most = questions.agg(F.max("k")).first()[0] or 0
    up = F.upper(F.col(chapter))
    keys = F.array(
        _key(up, F.col(article)), _key(up, F.lit(None)), _key(F.lit(None), F.col(article))
    )
    keyed = docs.select(*order, F.explode(F.array_distinct(keys)).alias("__key"))
    first = W.partitionBy("__key").orderBy(*order)
    top = keyed.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)
    asked = questions.where(F.col("chapter").isNotNull() | F.col("article").isNotNull())
    asked = asked.withColumn("__key", _key(F.col("chapter"), F.col("article")))
    return asked.join(top, "__key").where(F.col("rank") <= F.col("k")).drop("__key")


QUERY_BYTES = 128 * 1024 * 1024  # query vectors that may be sent to every task
BLOCK_ROWS = 20_000


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """Vectors of one Arrow column, one row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    cells = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return cells.reshape(rows, -1) if rows else cells.reshape(0, 1)


def _nearest(
    base: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the k nearest rows of each query, equal distances by id.

    A matrix product finds a few more candidates than needed, and their distances are taken
    from the differences. Where rounding could hide a nearer row, all near rows are compared."""
    n = len(ids)
    kk, kc = min(k, n), min(k + 8, n)
    out_ids, out_dist = np.empty((len(queries), kk), dtype=ids.dtype), np.empty((len(queries), kk))
    base_sq = np.einsum("ij,ij->i", base, base)
    for start in range(0, len(queries), 256):
        chunk = queries[start : start + 256]
        chunk_sq = np.einsum("ij,ij->i", chunk, chunk)
        rough = base_sq[None, :] - 2.0 * (chunk @ base.T) + chunk_sq[:, None]
        slack = 1e-9 * (chunk_sq + base_sq.max() + 1.0)
        near = np.argpartition(rough, kc - 1, axis=1)[:, :kc]
        gaps = base[near] - chunk[:, None, :]
        dist = np.einsum("qcd,qcd->qc", gaps, gaps)
        first = np.lexsort((ids[near], dist), axis=1)[:, :kk]
        best_ids = np.take_along_axis(ids[near], first, axis=1)
        best_dist = np.take_along_axis(dist, first, axis=1)
        edge = np.take_along_axis(rough, near, axis=1).max(axis=1)
        for i in np.flatnonzero(best_dist[:, -1] >= edge - slack) if kc < n else ():
            close = np.flatnonzero(rough[i] <= best_dist[i, -1] + slack[i])
            d = ((base[close] - chunk[i]) ** 2).sum(axis=1)
            order = np.lexsort((ids[close], d))[:kk]
            best_ids[i], best_dist[i] = ids[close][order], d[order]
        out_ids[start : start + 256], out_dist[start : start + 256] = best_ids, best_dist
    return out_ids, out_dist


def _hits(query_ids: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> dict[str, np.ndarray]:
    return {"q": np.repeat(query_ids, ids.shape[1]), "b": ids.ravel(), "d": dist.ravel()}


HITS = "q bigint, b bigint, d double"


def vector_topk(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    base_id: str = "vec_id",
    query_id: str = "query_id",
    vector: str = "embedding",
    query_bytes: int = QUERY_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The exact k nearest base rows of each query by L2 distance, equal distances by id:
    `(query id, rank, base id, distance)`. Ids are whole numbers; rows without a vector are
    left out.

    Each task keeps k rows per query of its part of the base; these are merged by query.
    Query vectors within `query_bytes` are sent to all tasks; a larger set is cut into
    blocks that meet the blocks of the base in a cogroup."""
    base = base.select(F.col(base_id).cast("bigint").alias("b"), F.col(vector).alias("v")).where("v IS NOT NULL")
    queries = queries.select(F.col(query_id).cast("bigint").alias("q"), F.col(vector).alias("v")).where(
        "v IS NOT NULL"
    )
    size = queries.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("cells")
    ).first()

    if size["cells"] * 8 <= query_bytes:
        local = queries.toArrow()  # bounded by query_bytes
        shared = base.sparkSession.sparkContext.broadcast(
            (local.column("q").to_numpy(), _matrix(local.column("v"), len(local)))
        )

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qid, qmat = shared.value
            ids = dist = None
            for batch in batches:
                if not len(batch) or not len(qid):
                    continue
                new_ids, new_dist = _nearest(_matrix(batch.column("v"), len(batch)), batch.column("b").to_numpy(), qmat, k)
                if ids is not None:
                    new_ids, new_dist = np.hstack([ids, new_ids]), np.hstack([dist, new_dist])
                    order = np.lexsort((new_ids, new_dist), axis=1)[:, :k]
                    new_ids = np.take_along_axis(new_ids, order, axis=1)
                    new_dist = np.take_along_axis(new_dist, order, axis=1)
                ids, dist = new_ids, new_dist
            if ids is not None:
                yield pa.RecordBatch.from_pydict(_hits(qid, ids, dist))

        partial = base.mapInArrow(scan, HITS)
    else:
        query_blocks = max(1, -(-size["n"] // block_rows))
        base_blocks = max(1, -(-base.count() // block_rows))

        def spread(df: DataFrame, own: str, own_n: int, other: str, other_n: int, key: str) -> DataFrame:
            return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(own_n)).cast("int")).withColumn(
                other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
            )

        left = spread(base, "bb", base_blocks, "qb", query_blocks, "b")
        right = spread(queries, "qb", query_blocks, "bb", base_blocks, "q")

        def meet(a: pa.Table, b: pa.Table) -> pa.Table:
            if not len(a) or not len(b):
                return pa.table({"q": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
            found = _nearest(
                _matrix(a.column("v"), len(a)), a.column("b").to_numpy(), _matrix(b.column("v"), len(b)), k
            )
            return pa.table(_hits(b.column("q").to_numpy(), *found))

        partial = left.groupBy("bb", "qb").cogroup(right.groupBy("bb", "qb")).applyInArrow(meet, HITS)

    rank = F.row_number().over(W.partitionBy("q").orderBy("d", "b"))
    return (
        partial.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select(F.col("q").alias(query_id), "rank", F.col("b").alias(base_id), F.sqrt("d").alias("distance"))
    )


def hybrid_search(
    questions: DataFrame,
    docs: DataFrame,
    *,
    question_id: str,
    doc_id: str,
    vector: str = "embedding",
    chapter: str = "bob",
    article: str = "modda",
) -> DataFrame:
    """Lookup by metadata; questions without a hit get the nearest vectors instead.
    `(question id, rank, document id, found_by)`."""
    hits = metadata_lookup(questions.drop(vector), docs, [doc_id], chapter, article).select(
        question_id, "rank", doc_id, F.lit("metadata").alias("found_by")
    )
    # Both are read several times below.
    hits = written(hits, "hits")
    missed = written(questions.join(hits.select(question_id), question_id, "left_anti"), "missed")
    most = missed.agg(F.max("k")).first()[0] or 1
    near = vector_topk(
        docs, missed, most, base_id=doc_id, query_id=question_id, vector=vector
    )
    near = (
        near.join(missed.select(question_id, "k"), question_id)
        .where(F.col("rank") <= F.col("k"))
        .select(question_id, "rank", doc_id, F.lit("vector").alias("found_by"))
    )
    return hits.unionByName(near)


def context_build(hits: DataFrame, keys: list[str]) -> DataFrame:
    """One context text per question from its ranked documents (at most k each)."""
    block = F.concat(
        F.lit("["), F.col("bob"), F.lit(" bob "), F.col("modda"), F.lit("-modda - "), F.col("bob_name"),
        F.lit("]\n"), F.col("page_content"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))
    return hits.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda r: r["block"]), "\n\n").alias("context")
    )


def prompt_build(df: DataFrame, question: str, context: str = "context", out: str = "prompt") -> DataFrame:
    """The specific template when chapter and article are named, else the general one."""

    def filled(parts: tuple[str, str, str]) -> Column:
        before, between, after = (F.lit(p) for p in parts)
        return F.concat(before, F.coalesce(F.col(context), F.lit("")), between, F.col(question), after)

    return df.withColumn(out, F.when(F.col("specific"), filled(SPECIFIC_PROMPT)).otherwise(filled(GENERAL_PROMPT)))


def source_report(hits: DataFrame, keys: list[str], width: int = 200) -> DataFrame:
    """Ranked sources with their place in the text and a preview."""
    return hits.select(
        *keys,
        "rank",
        F.concat(F.col("bob"), F.lit(" - "), F.col("bob_name")).alias("bob_line"),
        "modda",
        preview(F.col("page_content"), width).alias("preview"),
    )
