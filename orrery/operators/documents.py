"""Long texts to titled articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orrery.functions.text import SPACE, preview, strip
from orrery.operators.ordered import BUCKET, running

# Heading shapes of sections, chapters and articles, and the mark of a missing one.
SECTION_PATTERN = rf"(?ius)^([A-Z]{{2,}})[{SPACE}]+BO['‘’]LIM[.{SPACE}]*(.*?)$"
CHAPTER_PATTERN = rf"(?ius)^([IVXLCDM]+)[{SPACE}]+bob[.{SPACE}]*(.*?)$"
ARTICLE_PATTERN = rf"(?s)^(\p{{Nd}}+)-modda[.{SPACE}]*$"
MISSING = "N/A"
SHORT_NAME = 10  # a section name below this length goes on in the next line

PAGES_PER_TASK = 1024  # pages of one document that are scanned together


def split_lines(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """Trimmed lines, numbered from 0, each with the line after it."""
    lines = F.transform(F.split(F.col(text), "\n"), strip).alias("__lines")
    return texts.select(doc, lines).select(
        doc,
        F.posexplode(
            F.arrays_zip(
                F.col("__lines").alias("line"), F.slice("__lines", 2, F.size("__lines")).alias("next_line")
            )
        ).alias("line_no", "__l"),
    ).select(doc, "line_no", "__l.line", "__l.next_line")


def heading_kind(line: Column) -> Column:
    """`section`, `chapter`, `article`, or null for text."""
    return (
        F.when(line.rlike(SECTION_PATTERN), F.lit("section"))
        .when(line.rlike(CHAPTER_PATTERN), F.lit("chapter"))
        .when(line.rlike(ARTICLE_PATTERN), F.lit("article"))
    )


def is_heading(line: Column) -> Column:
    return line.rlike(SECTION_PATTERN) | line.rlike(CHAPTER_PATTERN) | line.rlike(ARTICLE_PATTERN)


def heading_label(line: Column, kind: Column) -> Column:
    """The word of a section, numeral of a chapter or number of an article."""
    return (
        F.when(kind == "section", F.regexp_extract(line, SECTION_PATTERN, 1))
        .when(kind == "chapter", F.regexp_extract(line, CHAPTER_PATTERN, 1))
        .when(kind == "article", F.regexp_extract(line, ARTICLE_PATTERN, 1))
    )


def heading_name(line: Column, next_line: Column, kind: Column) -> Column:
    """The title after the heading word. A short section title takes in the next line
    unless that is a chapter; an empty chapter title is the next line."""
    section = strip(F.regexp_extract(line, SECTION_PATTERN, 2))
    goes_on = (F.length(section) < SHORT_NAME) & (next_line != "") & ~next_line.rlike(CHAPTER_PATTERN)
    chapter = strip(F.regexp_extract(line, CHAPTER_PATTERN, 2))
    return F.when(
        kind == "section",
        F.when(goes_on, strip(F.concat(section, F.lit(" "), next_line))).otherwise(section),
    ).when(
        kind == "chapter", F.when((chapter == "") & next_line.isNotNull(), next_line).otherwise(chapter)
    )


def headings(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """Heading lines with kind, label and name."""
    lines = split_lines(texts, doc, text).withColumn("kind", heading_kind(F.col("line")))
    found = lines.where(F.col("kind").isNotNull())
    line, kind = F.col("line"), F.col("kind")
    return found.select(
        doc,
        "line_no",
        "kind",
        heading_label(line, kind).alias("label"),
        heading_name(line, F.col("next_line"), kind).alias("name"),
    )


def _parts(texts: DataFrame, ids: list[str], text: str) -> DataFrame:
    """Per row, an array of its headings, each with the text up to the next one; the part
    before the first heading has line number -1."""
    rows = texts.select(*ids, F.transform(F.split(F.col(text), "\n"), strip).alias("l"))
    spots = F.filter(F.transform("l", lambda x, i: F.when(is_heading(x), i)), lambda i: i.isNotNull())
    rows = rows.select("*", F.concat(F.array(F.lit(-1)), spots).alias("at"))

    def part(p: Column, j: Column) -> Column:
        stop = F.coalesce(F.get(F.col("at"), j + 1), F.size("l"))
        inner = F.filter(F.slice("l", p + 2, stop - p - 1), lambda x: x != "")
        return F.struct(
            p.alias("line_no"),
            F.when(p >= 0, F.get("l", p)).alias("line"),
            F.get("l", p + 1).alias("next_line"),
            F.array_join(inner, " ").alias("body"),
        )

    return rows.select(*ids, F.transform("at", part).alias("parts"))


def _carry(rows: DataFrame, kind: str) -> DataFrame:
    """Give every element of `heads` the last heading of this kind up to it, as a field.

    The array is cut into runs that start at those headings, so each element is visited once."""
    starts = F.filter(F.transform("heads", lambda h, i: F.when(h["kind"] == kind, i)), lambda i: i.isNotNull())
    rows = rows.withColumn("runs", F.concat(F.array(F.lit(-1)), starts))

    def run(start: Column, j: Column) -> Column:
        first = F.greatest(start, F.lit(0))
        stop = F.coalesce(F.get(F.col("runs"), j + 1), F.size("heads"))
        head = F.get("heads", start)
        mark = F.when(start >= 0, F.struct(head["label"].alias("label"), head["name"].alias("name")))
        return F.transform(F.slice("heads", first + 1, stop - first), lambda h: h.withField(kind, mark))

    return rows.withColumn("heads", F.flatten(F.transform("runs", run))).drop("runs")


def _articles_in_rows(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """Articles of documents that are one row each: all inside the row, nothing is shuffled."""

    def head(h: Column) -> Column:
        return F.struct(
            h["line_no"].alias("line_no"),
            h["kind"].alias("kind"),
            heading_label(h["line"], h["kind"]).alias("label"),
            heading_name(h["line"], h["next_line"], h["kind"]).alias("name"),
            h["body"].alias("body"),
        )

    rows = _parts(texts, [doc], text)
    found = F.filter("parts", lambda p: p["line_no"] >= 0)
    kinds = F.transform(found, lambda p: p.withField("kind", heading_kind(p["line"])))
    rows = rows.select(doc, F.transform(kinds, head).alias("heads"))
    rows = _carry(_carry(rows, "section"), "chapter")
    return rows.select(doc, F.inline(F.filter("heads", lambda h: h["kind"] == "article")))


def _articles_over_pages(texts: DataFrame, doc: str, text: str, page: str) -> DataFrame:
    """Articles of documents that are many rows: headings are carried from page to page, and
    the parts of an article are joined."""
    firsts = texts.select(
        doc, (F.col(page) - 1).alias(page), strip(F.substring_index(text, "\n", 1)).alias("__first")
    )
    parts = _parts(texts, [doc, page], text).select(doc, page, F.inline_outer("parts"))  # every page has a part; inline adds a filter that parses the page again
    parts = parts.join(firsts, [doc, page], "left").withColumn(
        "next_line", F.coalesce("next_line", "__first")
    )
    line = F.col("line")
    parts = parts.withColumn("kind", heading_kind(line))
    kind, head = F.col("kind"), F.struct("label", "name")
    parts = parts.withColumns(
        {"label": heading_label(line, kind), "name": heading_name(line, F.col("next_line"), kind)}
    ).drop("line", "next_line", "__first")
    scanned = running(
        parts.withColumn(BUCKET, F.floor(F.col(page) / PAGES_PER_TASK)),
        [page, "line_no"],
        keys=[doc],
        sums={"block": F.when(kind.isNotNull(), 1).otherwise(0)},
        lasts={
            "open_kind": kind,
            "section": F.when(kind == "section", head),
            "chapter": F.when(kind == "chapter", head),
        },
    ).where("open_kind = 'article'")
    pieces = F.array_sort(F.collect_list(F.struct(page, "line_no", "body")))
    body = F.array_join(F.filter(F.transform(pieces, lambda r: r["body"]), lambda b: b != ""), " ")
    start = F.min(F.when(kind.isNotNull(), F.struct(page, "line_no", "label", "section", "chapter")))
    joined = scanned.groupBy(doc, "block").agg(start.alias("s"), body.alias("body"))
    return joined.select(doc, "s.*", "body")


def articles(texts: DataFrame, doc: str, text: str, page: str | None = None) -> DataFrame:
    """Articles with their section and chapter; order them by document, page and line.

    Without `page` a row is a whole document and no row is moved. With `page`, a document is
    many rows with consecutive page numbers and an article may run over pages: the document
    is never put together, and its headings are carried down block by block, so a document with
    a third of all pages is many tasks."""
    ids = [doc] + ([page] if page else [])
    found = _articles_over_pages(texts, doc, text, page) if page else _articles_in_rows(texts, doc, text)

    def shown(c: str) -> Column:
        return F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(MISSING)).otherwise(F.col(c))

    return found.where("body <> ''").select(
        *[F.col(c) for c in ids],
        "line_no",
        shown("section.label").alias("bolim"),
        shown("section.name").alias("bolim_name"),
        shown("chapter.label").alias("bob"),
        shown("chapter.name").alias("bob_name"),
        F.col("label").alias("modda"),
        F.lit("article").alias("type"),
        F.col("body").alias("page_content"),
    )


def find_article(found: DataFrame, article: str, chapter: str, order: list[str]) -> DataFrame:
    """The first article with this number in this chapter."""
    return found.where((F.col("modda") == article) & (F.col("bob") == chapter)).orderBy(*order).limit(1)


def with_preview(df: DataFrame, text: str, width: int, out: str = "preview") -> DataFrame:
    return df.withColumn(out, preview(F.col(text), width))
