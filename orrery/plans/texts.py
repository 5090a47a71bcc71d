"""Queries over documents and retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orrery.functions.text import SPACE_CHARS
from orrery.operators import documents as D, retrieve as R
from orrery.plans.registry import Tables, query, rounded
from orrery.sources.storage import written


def re2(pattern: str) -> str:
    """A pattern as an SQL literal; its case folding needs no Unicode flag there."""
    return pattern.replace("(?ius)", "(?is)").replace("(?iu)", "(?i)").replace("'", "''")


def strip_sql(x: str) -> str:
    chars = " || ".join(f"chr({ord(c)})" for c in SPACE_CHARS)
    return f"trim({x}, {chars})"


# The texts have no headings, so heading lines are derived from the line numbers.
def _heading_line(i: Column) -> Column:
    word = F.element_at(F.array(*[F.lit(w) for w in ("BIRINCHI", "Ikkinchi", "UCHINCHI")]), i % 3 + 1)
    mark = F.element_at(F.array(*[F.lit(w) for w in (" BO'LIM", " BO‘LIM. ", " bo’lim")]), i % 3 + 1)
    title = F.when(i % 2 == 0, F.lit(" Asosiy qoidalar va tamoyillar")).otherwise(F.lit(""))
    roman = F.element_at(F.array(*[F.lit(w) for w in ("I", "ii", "III", "IV", "V")]), F.floor(i / 5).cast("int") % 5 + 1)
    chapter = F.when(i % 3 == 0, F.lit(" bob. Umumiy qoidalar")).otherwise(F.lit(" bob "))
    return (
        F.when(i % 11 == 0, F.concat(word, mark, title, F.lit("\n")))
        .when(i % 5 == 1, F.concat(roman, chapter, F.lit("\n")))
        .when(i % 3 == 2, F.concat(i.cast("string"), F.lit("-modda.\n")))
        .otherwise(F.lit(""))
    )


def law_texts(t: Tables) -> DataFrame:
    """The documents with section, chapter and article headings between their lines."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(_heading_line(i), x))
    return t.documents.select("doc_id", F.array_join(lines, "\n").alias("text"))


_HEADING_SQL = """CASE WHEN (i - 1) % 11 = 0 THEN ['BIRINCHI', 'Ikkinchi', 'UCHINCHI'][((i - 1) % 3 + 1)::INT]
    || [' BO''LIM', ' BO‘LIM. ', ' bo’lim'][((i - 1) % 3 + 1)::INT] || CASE WHEN (i - 1) % 2 = 0 THEN ' Asosiy qoidalar va tamoyillar' ELSE '' END || chr(10)
    WHEN (i - 1) % 5 = 1 THEN ['I', 'ii', 'III', 'IV', 'V'][(((i - 1) // 5) % 5 + 1)::INT]
    || CASE WHEN (i - 1) % 3 = 0 THEN ' bob. Umumiy qoidalar' ELSE ' bob ' END || chr(10)
    WHEN (i - 1) % 3 = 2 THEN (i - 1) || '-modda.' || chr(10) ELSE '' END"""

_LINES = f"""law AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: {_HEADING_SQL} || x), chr(10)) AS text FROM documents),
    raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM law),
    lines AS (SELECT doc_id, line_no, {strip_sql('line')} AS line FROM raw),
    kinds AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS next_line,
      CASE WHEN regexp_matches(line, '{re2(D.SECTION_PATTERN)}') THEN 'section'
           WHEN regexp_matches(line, '{re2(D.CHAPTER_PATTERN)}') THEN 'chapter'
           WHEN regexp_matches(line, '{re2(D.ARTICLE_PATTERN)}') THEN 'article' END AS kind FROM lines),
    heads AS (SELECT doc_id, line_no, line, kind, next_line,
      CASE kind WHEN 'section' THEN regexp_extract(line, '{re2(D.SECTION_PATTERN)}', 1) WHEN 'chapter' THEN regexp_extract(line, '{re2(D.CHAPTER_PATTERN)}', 1)
           WHEN 'article' THEN regexp_extract(line, '{re2(D.ARTICLE_PATTERN)}', 1) END AS label,
      {strip_sql(f"regexp_extract(line, '{re2(D.SECTION_PATTERN)}', 2)")} AS s_name, {strip_sql(f"regexp_extract(line, '{re2(D.CHAPTER_PATTERN)}', 2)")} AS c_name FROM kinds),
    named AS (SELECT doc_id, line_no, line, kind, label, CASE kind
      WHEN 'section' THEN CASE WHEN length(s_name) < 10 AND next_line <> '' AND NOT regexp_matches(next_line, '{re2(D.CHAPTER_PATTERN)}')
           THEN {strip_sql("s_name || ' ' || next_line")} ELSE s_name END
      WHEN 'chapter' THEN CASE WHEN c_name = '' AND next_line IS NOT NULL THEN next_line ELSE c_name END END AS name FROM heads)"""

_ARTICLES = f"""{_LINES},
    carried AS (SELECT *, count(kind) OVER w AS block,
      last_value(CASE WHEN kind = 'section' THEN label END IGNORE NULLS) OVER w AS s_label, last_value(CASE WHEN kind = 'section' THEN name END IGNORE NULLS) OVER w AS s_title,
      last_value(CASE WHEN kind = 'chapter' THEN label END IGNORE NULLS) OVER w AS c_label, last_value(CASE WHEN kind = 'chapter' THEN name END IGNORE NULLS) OVER w AS c_title
      FROM named WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
    bodies AS (SELECT doc_id, block, string_agg(line, ' ' ORDER BY line_no) AS page_content FROM carried WHERE kind IS NULL AND line <> '' GROUP BY 1, 2),
    articles AS (SELECT h.doc_id, CAST(h.line_no AS INTEGER) AS line_no, coalesce(nullif(s_label, ''), 'N/A') AS bolim, coalesce(nullif(s_title, ''), 'N/A') AS bolim_name,
      coalesce(nullif(c_label, ''), 'N/A') AS bob, coalesce(nullif(c_title, ''), 'N/A') AS bob_name, label AS modda, 'article' AS type, page_content
      FROM carried h JOIN bodies b ON h.doc_id = b.doc_id AND h.block = b.block WHERE kind = 'article')"""


@query(
    f"""SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, {strip_sql('line')} AS line FROM
    (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents) t"""
)
def split_lines(spark, sf):
    return D.split_lines(Tables(spark, sf).documents, "doc_id", "text").drop("next_line")


@query(f"WITH {_LINES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, kind FROM kinds WHERE kind IS NOT NULL")
def heading_detect(spark, sf):
    lines = D.split_lines(law_texts(Tables(spark, sf)), "doc_id", "text")
    found = lines.select("doc_id", "line_no", D.heading_kind(F.col("line")).alias("kind"))
    return found.where("kind IS NOT NULL")


@query(f"WITH {_LINES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, kind, label, name FROM named WHERE kind IS NOT NULL")
def heading_name(spark, sf):
    return D.headings(law_texts(Tables(spark, sf)), "doc_id", "text")


def _articles(t: Tables) -> DataFrame:
    return D.articles(law_texts(t), "doc_id", "text")


@query(f"WITH {_ARTICLES} SELECT doc_id, line_no, modda, bolim, bolim_name, bob, bob_name FROM articles")
def heading_ffill(spark, sf):
    found = _articles(Tables(spark, sf))
    return found.select("doc_id", "line_no", "modda", "bolim", "bolim_name", "bob", "bob_name")


@query(f"WITH {_ARTICLES} SELECT * FROM articles")
def article_assemble(spark, sf):
    return _articles(Tables(spark, sf))


@query(
    f"""WITH law AS (SELECT conv_id AS doc_id, string_agg(CASE WHEN turn % 2 = 0 THEN (turn + 1) || '-modda' || chr(10) || text
      WHEN turn % 5 = 3 THEN text || chr(10) || 'III bob' ELSE text END, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1),
    {_ARTICLES.split('FROM documents),', 1)[1]} SELECT doc_id, bob, bob_name, modda, page_content FROM articles"""
)
def article_assemble_paged(spark, sf):
    """Conversations as paged documents: articles run over pages, and so does a heading's title."""
    turn, text = F.col("turn"), F.col("text")
    pages = Tables(spark, sf).conversations.select(
        F.col("conv_id").alias("doc_id"),
        turn.alias("page_no"),
        F.when(turn % 2 == 0, F.concat((turn + 1).cast("string"), F.lit("-modda\n"), text))
        .when(turn % 5 == 3, F.concat(text, F.lit("\nIII bob")))
        .otherwise(text)
        .alias("text"),
    )
    found = D.articles(pages, "doc_id", "text", page="page_no")
    return found.select("doc_id", "bob", "bob_name", "modda", "page_content")


@query(
    f"""WITH {_ARTICLES} SELECT doc_id, line_no, bolim, bob, modda, page_content FROM articles WHERE modda = '2' AND bob = 'I'
    ORDER BY doc_id, line_no LIMIT 1"""
)
def find_article(spark, sf):
    hit = D.find_article(_articles(Tables(spark, sf)), "2", "I", ["doc_id", "line_no"])
    return hit.select("doc_id", "line_no", "bolim", "bob", "modda", "page_content")


@query("SELECT doc_id, substr(text, 1, 150) || '...' AS preview FROM documents")
def preview(spark, sf):
    return D.with_preview(Tables(spark, sf).documents.select("doc_id", "text"), "text", 150).drop("text")


def questions(t: Tables) -> DataFrame:
    """What users ask, with a reference added that differs by conversation."""
    tails = [" II bob 5-modda nima deyiladi?", " iii bob haqida?", " 17 - modda haqida?", " III   bob, 8 modda?", ""]
    tail = F.element_at(F.array(*[F.lit(x) for x in tails]), (F.col("conv_id") % 5 + 1).cast("int"))
    return t.conversations.where("role = 'user'").select(
        (F.col("conv_id") * 65536 + F.col("turn")).alias("query_id"), F.concat(F.col("text"), tail).alias("question")
    )


_REFS = f"""asked AS (SELECT conv_id * 65536 + turn AS query_id, text || [' II bob 5-modda nima deyiladi?', ' iii bob haqida?', ' 17 - modda haqida?',
      ' III   bob, 8 modda?', ''][(conv_id % 5 + 1)::INT] AS question, conv_id FROM conversations WHERE role = 'user'),
    found AS (SELECT *, nullif(upper(regexp_extract(question, '{re2(R.CHAPTER_REF)}', 1)), '') AS chapter,
      nullif(regexp_extract(question, '{re2(R.ARTICLE_REF)}', 1), '') AS article FROM asked),
    refs AS (SELECT query_id, question, conv_id, chapter, article, chapter IS NOT NULL AND article IS NOT NULL AS specific,
      CASE WHEN chapter IS NOT NULL AND article IS NOT NULL THEN 3 ELSE 5 END AS k FROM found)"""


@query(f"WITH {_REFS} SELECT query_id, question, chapter, article, specific, k FROM refs")
def query_refs(spark, sf):
    return R.query_refs(questions(Tables(spark, sf)), "question")


_HITS = f"""{_ARTICLES}, {_REFS},
    hits AS (SELECT query_id, question, specific, k, rank, doc_id, line_no, bob, bob_name, modda, page_content FROM
      (SELECT r.*, a.*, CAST(row_number() OVER (PARTITION BY query_id ORDER BY doc_id, line_no) AS INTEGER) AS rank
       FROM refs r JOIN articles a ON (chapter IS NULL OR upper(a.bob) = chapter) AND (article IS NULL OR a.modda = article)
       WHERE chapter IS NOT NULL OR article IS NOT NULL) t WHERE rank <= k)"""


def _hits(t: Tables) -> DataFrame:
    """Ranked articles of the questions, with their text. The articles are a written table,
    read once by their references and once for the texts of the hits."""
    found = written(_articles(t), "articles")
    refs = R.query_refs(questions(t), "question")
    ranked = R.metadata_lookup(refs, found, ["doc_id", "line_no"])
    return ranked.join(found, ["doc_id", "line_no"])


@query(f"WITH {_HITS} SELECT query_id, rank, doc_id, line_no, bob, modda FROM hits")
def metadata_lookup(spark, sf):
    return _hits(Tables(spark, sf)).select("query_id", "rank", "doc_id", "line_no", "bob", "modda")


@query(f"WITH {_HITS.replace('THEN 3 ELSE 5 END AS k', 'THEN 10 ELSE 10 END AS k')} SELECT query_id, rank, doc_id, line_no FROM hits")
def metadata_lookup_deep(spark, sf):
    """Ten articles per question."""
    t = Tables(spark, sf)
    refs = R.query_refs(questions(t), "question").withColumn("k", F.lit(10))
    return R.metadata_lookup(refs, written(_articles(t), "articles"), ["doc_id", "line_no"]).select("query_id", "rank", "doc_id", "line_no")


def centroids(t: Tables) -> DataFrame:
    """Mean vector per label: one query each."""
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One cell per vector position, so each list has the length of a vector.
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(ordered, lambda c: c["x"]).alias("embedding")
    )


_VECTORS = """cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    means AS (SELECT label AS query_id, i, avg(x) AS m FROM cells GROUP BY 1, 2),
    gaps AS (SELECT query_id, vec_id, sqrt(sum(pow(x - m, 2))) AS d FROM cells JOIN means ON cells.i = means.i GROUP BY 1, 2)"""


@query(
    f"""WITH {_VECTORS} SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(d, 6) AS distance FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM gaps) t WHERE rank <= 5"""
)
def vector_topk(spark, sf):
    t = Tables(spark, sf)
    return rounded(R.vector_topk(t.embeddings, centroids(t), 5), 6, "distance")


def _library(t: Tables) -> DataFrame:
    """The vectors as documents: the label gives the chapter, the position the article."""
    roman = F.array(*[F.lit(x) for x in ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X")])
    return t.embeddings.select(
        F.col("vec_id").alias("doc_id"),
        "embedding",
        F.element_at(roman, F.col("label") + 1).alias("bob"),
        (F.col("vec_id") % 40).cast("string").alias("modda"),
    )


@query(
    f"""WITH {_REFS}, {_VECTORS},
    library AS (SELECT vec_id AS doc_id, ['I','II','III','IV','V','VI','VII','VIII','IX','X'][label + 1] AS bob, CAST(vec_id % 40 AS VARCHAR) AS modda FROM embeddings),
    hits AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rank, k, doc_id FROM refs JOIN library l
      ON (chapter IS NULL OR l.bob = chapter) AND (article IS NULL OR l.modda = article) WHERE chapter IS NOT NULL OR article IS NOT NULL),
    near AS (SELECT r.query_id, row_number() OVER (PARTITION BY r.query_id ORDER BY d, vec_id) AS rank, k, vec_id AS doc_id FROM refs r
      JOIN gaps g ON g.query_id = r.conv_id % 10 WHERE r.query_id NOT IN (SELECT query_id FROM hits))
    SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, 'metadata' AS found_by FROM hits WHERE rank <= k
    UNION ALL SELECT query_id, CAST(rank AS INTEGER), doc_id, 'vector' FROM near WHERE rank <= k"""
)
def hybrid_search(spark, sf):
    """A question takes the mean vector of the label its conversation falls on."""
    t = Tables(spark, sf)
    refs = R.query_refs(questions(t), "question").withColumn(
        "label", F.floor(F.col("query_id") / 65536) % 10
    )
    vectors = centroids(t).withColumnRenamed("query_id", "label")
    asked = refs.join(vectors, "label").drop("label")
    return R.hybrid_search(asked, _library(t), question_id="query_id", doc_id="doc_id")


_CONTEXT = f"""{_HITS}, contexts AS (SELECT query_id, any_value(question) AS question, any_value(specific) AS specific, string_agg('[' || bob || ' bob ' || modda || '-modda - '
    || bob_name || ']' || chr(10) || page_content, chr(10) || chr(10) ORDER BY rank) AS context FROM hits GROUP BY 1)"""


def _contexts(t: Tables) -> DataFrame:
    return R.context_build(_hits(t), ["query_id", "question", "specific"])


@query(f"WITH {_CONTEXT} SELECT query_id, context FROM contexts")
def context_build(spark, sf):
    return _contexts(Tables(spark, sf)).select("query_id", "context")


def _template_sql(parts: tuple[str, str, str]) -> str:
    a, b, c = (p.replace("'", "''") for p in parts)
    return f"'{a}' || context || '{b}' || question || '{c}'"


@query(
    f"""WITH {_CONTEXT} SELECT query_id, CASE WHEN specific THEN {_template_sql(R.SPECIFIC_PROMPT)}
    ELSE {_template_sql(R.GENERAL_PROMPT)} END AS prompt FROM contexts"""
)
def prompt_build(spark, sf):
    return R.prompt_build(_contexts(Tables(spark, sf)), "question").select("query_id", "prompt")


@query(
    f"""WITH {_HITS} SELECT query_id, rank, bob || ' - ' || bob_name AS bob_line, modda, substr(page_content, 1, 200) || '...' AS preview FROM hits"""
)
def source_report(spark, sf):
    return R.source_report(_hits(Tables(spark, sf)), ["query_id"])
