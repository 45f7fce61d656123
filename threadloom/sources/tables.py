"""Reading processed tables back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.split import MIN_ID, STEP, last_id
from threadloom.schemas import COMMENTS_PROCESSED, POSTS_FEATURES, USERS_PROCESSED
from threadloom.sinks.tables import read_appended, read_table


def read_features(spark: SparkSession, path: str, min_id: int | None = None, max_id: int | None = None) -> DataFrame:
    """The feature table as written by the upsert; only folders with ids between the bounds are read."""
    rows = read_table(spark, path, POSTS_FEATURES, min_id, max_id)
    if min_id is not None:
        rows = rows.where(F.col("id") >= min_id)
    return rows if max_id is None else rows.where(F.col("id") <= max_id)


def read_users(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """Processed users of all published runs, or of one."""
    return read_appended(spark, path, USERS_PROCESSED, run=run)


def read_comments(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    return read_appended(spark, path, COMMENTS_PROCESSED, run=run)


def jdbc_read(spark: SparkSession, url: str, table: str, key: str = "id", lower: int = MIN_ID, upper: int = last_id(),
              partitions: int = (last_id() + 1 - MIN_ID) // STEP, **options) -> DataFrame:
    """Read a database table in parallel by ranges of its key."""
    return (spark.read.format("jdbc")
            .options(url=url, dbtable=table, partitionColumn=key, lowerBound=lower, upperBound=upper,
                     numPartitions=partitions, **options).load())
