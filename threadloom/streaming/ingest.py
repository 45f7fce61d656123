"""The same transforms on dump files as they arrive."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.plans.comments import comments_processed, comments_rejected
from threadloom.plans.posts import posts_features, posts_rejected
from threadloom.plans.users import users_processed, users_rejected
from threadloom.schemas import COMMENTS, POSTS, USERS
from threadloom.sinks.tables import upsert
from threadloom.sources.dump import stream_dump

BATCH = "batch"


def stream_comments(spark: SparkSession, src: str, dst: str, checkpoint: str, max_files: int | None = None,
                    rejects: str | None = None, layout: str = "text", **options) -> StreamingQuery:
    """Comments to a table with a folder per batch, each dump row exactly once, also after a restart.

    Rejected rows go to ``rejects``, by default beside the table, in the same way. ``layout`` is "xml" for elements that
    span lines.
    """
    refuse_other_data(spark, dst)
    return _start(stream_dump(spark, src, COMMENTS, max_files, layout), comments_rejected, rejects or f"{dst}-rejected", checkpoint,
                  lambda batch, name: _put(comments_processed(batch, **options), dst, name))


def stream_users(spark: SparkSession, src: str, dst: str, checkpoint: str, max_files: int | None = None,
                 rejects: str | None = None, layout: str = "text", **options) -> StreamingQuery:
    refuse_other_data(spark, dst)
    return _start(stream_dump(spark, src, USERS, max_files, layout), users_rejected, rejects or f"{dst}-rejected", checkpoint,
                  lambda batch, name: _put(users_processed(batch, **options), dst, name))


def stream_posts(spark: SparkSession, src: str, dst: str, checkpoint: str, max_files: int | None = None,
                 step: int | None = None, rejects: str | None = None, layout: str = "text", **options) -> StreamingQuery:
    """Posts upserted per micro-batch; a batch that is run again gives the same table."""
    return _start(stream_dump(spark, src, POSTS, max_files, layout), posts_rejected, rejects or f"{dst}-rejected", checkpoint,
                  lambda batch, name: upsert(batch.sparkSession, posts_features(batch, **options), dst,
                                             order=["lastactivitydate"], step=step))


def refuse_other_data(spark: SparkSession, dst: str) -> None:
    """A stream writes only to a new table or to one of streams: files beside the batch folders would hide them."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(dst)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    if not files.where(~F.col("path").contains(f"/{BATCH}=")).select("path").isEmpty():
        raise ValueError(f"{dst} has data that no stream wrote")


def _put(df: DataFrame, dst: str, name: str, kind: str = "parquet") -> None:
    """A batch that is run again replaces its own folder."""
    df.write.mode("overwrite").format(kind).save(f"{dst}/{BATCH}={name}")


def _start(raw: DataFrame, rejected: Callable[[DataFrame], DataFrame], rejects: str, checkpoint: str,
           store: Callable[[DataFrame, str], None]) -> StreamingQuery:
    own = f"{zlib.crc32(checkpoint.encode()):08x}"  # other streams into the same table keep their folders

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # parsed once; what an executor loses is parsed again
        try:
            store(batch, f"{own}-{batch_id}")
            _put(rejected(batch), rejects, f"{own}-{batch_id}", "json")
        finally:
            batch.unpersist()

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
