"""Headings and articles."""

import pytest

from orrery.operators import documents as D

TEXT = "\n".join(
    [
        "before any heading", "BIRINCHI BO‘LIM", "Asosiy qoidalar", "I bob", "Umumiy", "1-modda.", " first ", "", "second",
        "2-modda", "  ", "3-modda", "third", "ii BOB. Nomi bor", "4-modda.", "four", "IKKINCHI BO’LIM. Yetarlicha uzun nom",
        "after section", "5-modda", "five", "UCHINCHI bo'lim", "V bob", "6-modda", "six", "last",
    ]
)
# (section, its title, chapter, its title, article, text)
WANT = [
    ("BIRINCHI", "Asosiy qoidalar", "I", "Umumiy", "1", "first second"),
    ("BIRINCHI", "Asosiy qoidalar", "I", "Umumiy", "3", "third"),
    ("BIRINCHI", "Asosiy qoidalar", "ii", "Nomi bor", "4", "four"),
    ("IKKINCHI", "Yetarlicha uzun nom", "ii", "Nomi bor", "5", "five"),
    ("UCHINCHI", "N/A", "V", "6-modda", "6", "six last"),
]


def shown(df, order):
    cols = ["bolim", "bolim_name", "bob", "bob_name", "modda", "page_content"]
    return [tuple(r[c] for c in cols) for r in df.orderBy(*order).collect()]


def test_articles(spark):
    df = spark.createDataFrame([(1, TEXT)], "doc int, text string")
    assert shown(D.articles(df, "doc", "text"), ["line_no"]) == WANT


@pytest.mark.parametrize("cuts", [[5], [2, 3, 4, 7], list(range(1, 25))])
def test_articles_over_pages(spark, cuts):
    lines = TEXT.split("\n")
    edges = [0, *cuts, len(lines)]
    pages = [(1, i + 1, "\n".join(lines[a:b])) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    pages.append((2, 1, "1-modda\nalone"))
    df = spark.createDataFrame(pages, "doc int, page int, text string").repartition(4)
    out = D.articles(df, "doc", "text", page="page")
    assert shown(out.where("doc = 1"), ["page", "line_no"]) == WANT
    assert shown(out.where("doc = 2"), ["page"]) == [("N/A", "N/A", "N/A", "N/A", "1", "alone")]


def test_huge_document_over_pages(spark, monkeypatch):
    """One document holds nearly all pages; an article runs over many of them."""
    monkeypatch.setattr(D, "PAGES_PER_TASK", 16)
    pages = [(1, i + 1, f"{i}-modda\ntext {i}" if i % 50 == 0 else f"more {i}") for i in range(400)]
    df = spark.createDataFrame(pages, "doc int, page int, text string").repartition(8)
    out = D.articles(df, "doc", "text", page="page").orderBy("page").collect()
    assert [r["modda"] for r in out] == [str(i) for i in range(0, 400, 50)]
    assert out[1]["page_content"] == " ".join(["text 50", *[f"more {i}" for i in range(51, 100)]])


def test_no_heading_and_empty_text(spark):
    df = spark.createDataFrame([(1, "plain text"), (2, "")], "doc int, text string")
    assert D.articles(df, "doc", "text").count() == 0
    assert D.split_lines(df, "doc", "text").count() == 2


@pytest.mark.parametrize(
    "line,kind",
    [
        ("BIRINCHI BO'LIM", "section"), ("birinchi bo‘lim. X", "section"), ("B BO’LIM", None), ("IV bob", "chapter"),
        ("iv  BOB.Nomi", "chapter"), ("4 bob", None), ("12-modda", "article"), ("12-modda. matn", None), ("12-MODDA", None),
        ("٣-modda", "article"), ("XIV bob", "chapter"), ("", None),
    ],
)
def test_heading_kind(spark, line, kind):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(D.heading_kind(df["line"])).first()[0] == kind


def test_find_article_takes_the_first(spark):
    df = spark.createDataFrame([(1, TEXT), (2, TEXT)], "doc int, text string")
    found = D.articles(df, "doc", "text")
    assert D.find_article(found, "3", "I", ["doc", "line_no"]).first()["doc"] == 1
    assert D.find_article(found, "9", "I", ["doc"]).count() == 0
