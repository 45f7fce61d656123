"""Intermediate tables of an operator, in the folder that all executors share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_AT_ONCE = 2000
LEAST_TASKS = 12


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not f"{spark.conf.get('spark.master', '')}[".startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-work-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if it is not installed there, and
    has them get whole texts in batches of ROWS_AT_ONCE, unless the session says how many."""
    if spark.conf.get(_BATCH_ROWS, None) is None:
        spark.conf.set(_BATCH_ROWS, ROWS_AT_ONCE)
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if top not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [top, given]))


def dealt(df: DataFrame, rows: int, each: int = 20_000) -> DataFrame:
    """`df` in no more partitions than its `rows` need at `each` of them, but LEAST_TASKS: a shuffle deals them into as many as
    the session says, however few there are, and each costs a task and mostly a file. Rows that are together stay together."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // each)))


def tidy(run: Callable) -> Callable:
    """The same function for mapInArrow, giving memory back when its task ends: workers live on between tasks."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)
    return tidied


class Workspace:
    """Tables in a database of their own below the shared folder; they cut lineage, so work done before
    them is not repeated when an executor is lost. `drop` removes them, or the end of a `with` block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"work_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{shared_folder(spark)}/{self.name}'")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").format("parquet").saveAsTable(f"{self.name}.{name}")
        return self.spark.table(f"{self.name}.{name}")

    def forget(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}.{name}")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def result(spark: SparkSession, df: DataFrame) -> DataFrame:
    """`df` as a written table; it stays until its user's session or folder is cleaned."""
    return Workspace(spark).keep(df, "result")
