"""The corpus pipeline: stages that each apply one operator to all that the stage before kept.

Quality rules, near-duplicates, benchmark decontamination, secrets, source mixing. Every stage but the last returns the
columns of `documents`; each result is written as Parquet and read again as the next stage's input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orrery.llm import queries as Q
from orrery.llm.decontaminate import contained_items
from orrery.llm.mixing import mix
from orrery.llm.near_dedup import near_duplicates
from orrery.llm.quality_rules import quality_verdicts
from orrery.llm.secret_scan import redacted
from orrery.plans.registry import ORACLE, QUERIES, Tables
from orrery.sources.storage import written

MARK = "[secret]"


def _same_row(docs: DataFrame, keys: DataFrame) -> Column:
    """A document row is known by its doc_id and a hash of its text, either of which may be null."""
    return docs["doc_id"].cast("long").eqNullSafe(keys["__id"]) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(keys["__hash"])


def _keys(df: DataFrame, *more: Column) -> DataFrame:
    return df.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), *more)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    verdicts = quality_verdicts(docs, Tables(spark, sf_dir).labels)
    kept = _keys(verdicts.where("kept"))
    return docs.join(kept, _same_row(docs, kept), "left_semi")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates. Of rows that repeat a doc_id and its text one stays;
    different texts under one doc_id are one document and all stay. Rows without a doc_id stay."""
    copies = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    single = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    ids = single.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    ids = written(ids, "repeated")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = single.join(ids, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("__one"), *rest)).alias("r"))
    return single.join(ids, "doc_id", "left_anti").select(*docs.columns).unionByName(one.select("doc_id", "text", "r.*").select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = _keys(contained_items(docs, Tables(spark, sf_dir).benchmark)).distinct()
    return docs.join(found, _same_row(docs, found), "left_anti")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets replaced by a mark."""
    return redacted(docs, mark=MARK)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the target of their source and how often each is repeated."""
    mixed = mix(docs).where("repeats > 0").groupBy("doc_id", "text_hash").agg(F.max("target").alias("target"), F.max("repeats").alias("repeats"))
    taken = _keys(mixed, F.col("target"), F.col("repeats"))
    own = [docs[c] for c in docs.columns if c.lower() not in ("target", "repeats")]
    return docs.join(taken, _same_row(docs, taken)).select(*own, taken["target"], taken["repeats"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole table `documents`."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = rf"""
WITH d1 AS (SELECT d.* FROM documents d JOIN ({Q.quality_sql()}) q USING (doc_id) WHERE q.kept),
d2 AS (SELECT d1.* FROM d1 JOIN ({Q.near_sql("d1")}) n USING (doc_id) WHERE n.kept),
d3 AS (SELECT * FROM d2 WHERE doc_id NOT IN (SELECT doc_id FROM (WITH {Q.contained_sql("d2")} SELECT doc_id FROM h))),
s AS (WITH {Q.secret_spans_sql("d3")} SELECT doc_id, start, stop FROM v WHERE chosen),
i AS (
  SELECT doc_id, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop FROM (
    SELECT *, sum(CASE WHEN start < upto THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT *, max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM s))
  GROUP BY doc_id, island),
r AS (
  SELECT doc_id, string_agg(substr(text, past + 1, start - past) || '{MARK}', '' ORDER BY start) || substr(any_value(text), max(stop) + 1) AS text
  FROM (SELECT i.*, text, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS past FROM i JOIN d3 USING (doc_id))
  GROUP BY doc_id),
d4 AS (
  SELECT d3.doc_id, coalesce(r.text, d3.text) AS text, lang, source, CASE WHEN r.text IS NULL THEN n_chars ELSE length(r.text) END AS n_chars
  FROM d3 LEFT JOIN r USING (doc_id))
SELECT d4.*, m.target, m.repeats FROM d4 JOIN ({Q.mixing_sql("d4")}) m USING (doc_id) WHERE m.repeats > 0
"""

QUERIES["pipeline"] = run
ORACLE["pipeline"] = ORACLE_SQL
