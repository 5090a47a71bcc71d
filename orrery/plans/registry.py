"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orrery.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; without SQL only its rows are checked."""

    def add(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


class Tables:
    """The parquet tables of one folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self._spark, self._folder, name)


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round the named columns, so that the order of a sum does not show."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def col_round(x: Column, digits: int, name: str) -> Column:
    return F.round(x, digits).alias(name)
