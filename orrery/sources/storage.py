"""The shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def _root(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/orrery/{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's checkpoint directory.

    A machine-local folder is used only in local mode without that setting, where
    driver and executors are one process."""
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors can reach")
        base = tempfile.gettempdir()
    return f"{_root(spark, base)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all that this application has written to the work folder. Tables read from it are gone after that."""
    base = spark.conf.get(SETTING, None) or tempfile.gettempdir()
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark, base))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a written table: computed once, read by every later use, and safe when
    an executor is lost."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
