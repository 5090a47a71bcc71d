"""Readers and writers of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    missing: str = "",
    line_breaks: bool = False,
) -> DataFrame:
    """A CSV table; without a schema the types are inferred, at the cost of a second read.
    `line_breaks` allows them inside quoted values, but then a file is one task."""
    reader = (
        spark.read.option("header", header)
        .option("nullValue", missing)
        .option("escape", '"')
        .option("multiLine", line_breaks)
    )
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def sink_csv(df: DataFrame, path: str) -> None:
    """Write with a header and no row numbers, one file per partition."""
    df.write.option("header", True).option("escape", '"').csv(path)


def scan_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files that each hold one JSON array of records. A file is one task, so a large
    table belongs into many files."""
    reader = spark.read.option("multiLine", True)
    return reader.schema(schema).json(path) if schema else reader.json(path)


def json_array_rows(df: DataFrame, col: str, record: str) -> DataFrame:
    """Records of a column of JSON arrays, given their DDL schema."""
    return df.select(F.inline(F.from_json(F.col(col), f"array<struct<{record}>>")))


# Statement shape, separator and number format of the dump, and its fields.
VALUES_PATTERN = r"(?i)VALUES\s*\((.*?)\);?$"
SEPARATOR_PATTERN = r"\s*,\s*(?=(?:[^']*'[^']*')*[^']*$)"
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"
FINANCIALS = {
    "client_id": "bigint",
    "income": "double",
    "credit_score": "bigint",
    "loan_amount": "double",
    "past_due": "bigint",
    "monthly_expenses": "double",
    "savings_balance": "double",
}


def parse_insert_dump(
    lines: DataFrame, col: str = "value", fields: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of `INSERT ... VALUES (...)` lines, and the lines whose values do not parse.

    Commas inside single quotes do not separate; whole-number fields drop the fraction.
    Other statements, and an INSERT without a VALUES list, are neither."""
    fields = fields or FINANCIALS
    body = F.regexp_extract(col, VALUES_PATTERN, 1)
    found = lines.where(F.col(col).startswith("INSERT") & F.col(col).rlike(VALUES_PATTERN)).select(
        F.col(col).alias("line"), F.transform(F.split(body, SEPARATOR_PATTERN), lambda v: F.btrim(v, F.lit(" '"))).alias("v")
    )

    def field(i: int, kind: str):
        raw = F.get("v", F.lit(i))
        if kind == "string":
            return raw
        number = F.when(raw.rlike(NUMBER_PATTERN), F.trim(raw).try_cast("double"))
        return number if kind == "double" else number.try_cast(kind)

    parsed = found.select("line", *[field(i, k).alias(n) for i, (n, k) in enumerate(fields.items())])
    whole = F.lit(True)
    for name in fields:
        whole = whole & F.col(name).isNotNull()
    return parsed.where(whole).drop("line"), parsed.where(~whole).select("line")


def scan_insert_dump(spark: SparkSession, path: str, fields: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """`parse_insert_dump` of text files."""
    return parse_insert_dump(spark.read.text(path), "value", fields)


def load_sql_table(
    spark: SparkSession, path: str, view: str, fields: dict[str, str] | None = None
) -> DataFrame:
    """Register the rows of a dump as a view for SQL."""
    rows, _ = scan_insert_dump(spark, path, fields)
    rows.createOrReplaceTempView(view)
    return rows


PAGE_BLOCK = 256


def join_pages(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """One text per document, pages in order and separated by line breaks.

    Blocks of pages are joined first, so a document of very many pages is spread over tasks until
    its final text. To get lines or articles, use the page rows themselves."""

    def joined(order: str, part: str):
        ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(part).alias("t"))))
        return F.array_join(F.transform(ordered, lambda r: r["t"]), "\n")

    blocks = pages.groupBy(doc, F.floor(F.col(page) / PAGE_BLOCK).alias("__block")).agg(
        F.count(F.lit(1)).alias("__n"), joined(page, text).alias("__text")
    )
    return blocks.groupBy(doc).agg(F.sum("__n").alias("n_pages"), joined("__block", "__text").alias(text))


def page_dump(pages: DataFrame, doc: str, page: str, text: str, first: int = 20) -> DataFrame:
    """The first pages of each document as titled blocks, with its page count. Pages
    count from 1."""
    counts = pages.groupBy(doc).agg(F.count(F.lit(1)).alias("total_pages"))
    block = F.concat(
        F.lit("--- Page "), F.col(page).cast("string"), F.lit(" ---\n"), F.col(text), F.lit("\n\n")
    )
    shown = pages.where(F.col(page) <= first).select(doc, page, block.alias("block"))
    return shown.join(counts, doc)


def append_metrics(metrics: DataFrame, path: str, run: str) -> None:
    """Append metric rows of one run to a log table."""
    metrics.withColumn("run", F.lit(run)).write.mode("append").parquet(path)
