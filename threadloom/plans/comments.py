"""Comments: dump rows to the 7-column processed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.classify import comment_class
from threadloom.operators.validate import reject_reason, rejected, typed
from threadloom.plans.load import replay, run_dump
from threadloom.schemas import COMMENTS, COMMENTS_PROCESSED


def comment_reject_reason() -> Column:
    return reject_reason(COMMENTS)


def comments_processed(raw: DataFrame, table=None, **options) -> DataFrame:
    """Typed columns and the class of every valid row."""
    values = {c: typed(COMMENTS, c) for c in COMMENTS} | {
        "Text": F.coalesce("Text", F.lit("")),
        "CommentClass": comment_class(F.col("Text"), table, **options),
    }
    return raw.where(comment_reject_reason().isNull()).select(
        *[values[f.name].alias(f.name) for f in COMMENTS_PROCESSED])


def comments_rejected(raw: DataFrame) -> DataFrame:
    return rejected(raw, comment_reject_reason())


def run_comments(spark: SparkSession, src, dst: str, rejects: str | None = None, reader: str = "text", run: str | None = None,
                 **options) -> dict:
    """Dump to processed table, appended, read and parsed once; rejected rows as JSON in ``rejects``, by default beside
    the table. ``reader``: "text" for a row per line, "xml" for other layouts. Both are published when all is written;
    a dump that was loaded already adds nothing, unless it is named as another ``run``. Returns the run counters
    with the elapsed seconds."""
    return run_dump(spark, src, reader, run, COMMENTS, **_plan(dst, rejects, options))


def replay_comments(spark: SparkSession, corrected: DataFrame, dst: str, rejects: str | None = None, run: str | None = None, **options) -> dict:
    """Corrected rejects (see ``read_rejects``) to the same tables; their old entries are resolved."""
    return replay(spark, corrected, COMMENTS, run=run, **_plan(dst, rejects, options))


def _plan(dst: str, rejects: str | None, options: dict) -> dict:
    return {"reason": comment_reject_reason(), "transform": lambda good: comments_processed(good, **options), "schema": COMMENTS_PROCESSED,
            "dst": dst, "rejects": rejects or f"{dst}-rejected"}
