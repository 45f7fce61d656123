"""Rejected rows as a table: published once per run, each different row once, until a replay resolves it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators.validate import REASON
from threadloom.schemas import raw_schema
from threadloom.sinks import versions
from threadloom.sinks.tables import publish_append, read_appended, write_unpublished

ROW_HASH = "row_hash"
_RESOLVED = T.StructType([T.StructField(ROW_HASH, T.StringType())])


def row_hash(columns: dict[str, str]) -> Column:
    """Fingerprint of a raw row; rows with equal attributes have the same, whatever run or file they come from."""
    return F.sha2(F.to_json(F.struct(*raw_schema(columns).names)), 256)


def reject_schema(columns: dict[str, str]) -> T.StructType:
    return raw_schema(columns).add(REASON, "string").add(ROW_HASH, "string")


def resolved_path(path: str) -> str:
    return f"{path}-resolved"


def write_rejects(spark: SparkSession, rejects: DataFrame, columns: dict[str, str], path: str) -> str:
    """Rows with their reason, as JSON in a folder that still has to be published."""
    return write_unpublished(rejects.withColumn(ROW_HASH, row_hash(columns)).select(*reject_schema(columns).names), path, "json")


def read_rejects(spark: SparkSession, path: str, columns: dict[str, str], resolved: bool = False) -> DataFrame:
    """The different rejected rows of all runs, without those that a replay has resolved unless ``resolved``."""
    rows = read_appended(spark, path, reject_schema(columns), "json").dropDuplicates([ROW_HASH])
    if resolved:
        return rows
    return rows.join(read_appended(spark, resolved_path(path), _RESOLVED), ROW_HASH, "left_anti").select(*rows.columns)


def publish_rejects(spark: SparkSession, path: str, run: str, folder: str) -> bool:
    return publish_append(spark, path, run, folder)


def resolve(spark: SparkSession, path: str, run: str, corrected: DataFrame, columns: dict[str, str]) -> None:
    """Marks the rejects named by ``corrected`` (row_hash) as done, but for those that ``run`` rejected unchanged."""
    again = read_appended(spark, path, reject_schema(columns), "json", run).select(ROW_HASH)
    done = corrected.select(ROW_HASH).where(F.col(ROW_HASH).isNotNull()).distinct().join(again, ROW_HASH, "left_anti")
    target = resolved_path(path)
    if run not in versions.current(spark, target).folders:
        publish_append(spark, target, run, write_unpublished(done, target))
