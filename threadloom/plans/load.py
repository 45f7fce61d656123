"""A run: raw rows to a table and its rejected rows, each published once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators.validate import staged
from threadloom.sinks import dead_letters, versions
from threadloom.sinks.dead_letters import ROW_HASH
from threadloom.sinks.tables import ensure_table, publish_append, upsert, write_unpublished
from threadloom.sources.dump import READERS, dump_id


class AuditFailed(RuntimeError):
    """What was written is not what was counted when it was read; nothing of it was published."""


def load(spark: SparkSession, raw: DataFrame, columns: dict[str, str], reason: Column,
         transform: Callable[[DataFrame], DataFrame], schema: T.StructType, dst: str, rejects: str, run: str,
         order: list[str] | None = None) -> dict:
    """Write, audit, publish: rows and rejects are written beside their tables, counted, and then published, the
    rejects first. A run that fails on its way leaves no row that anybody sees, and can be run again.

    A table with ``order`` is upserted by id. Any other is appended to, and a run that it has already adds nothing.
    """
    ensure_table(spark, dst, schema)
    with staged(spark, raw, reason) as (good, bad, counters):
        rejected = dead_letters.write_rejects(spark, bad, columns, rejects)
        appended = order is None
        counters["added"] = run not in versions.current(spark, dst).folders
        folder = None
        if appended and counters["added"]:
            written = Observation()
            folder = write_unpublished(transform(good).observe(written, F.count(F.lit(1)).alias("rows")), dst)
            if written.get["rows"] != counters["stored"]:
                raise AuditFailed(f"{written.get['rows']} rows written of {counters['stored']} read: {dst}/{folder}")
        dead_letters.publish_rejects(spark, rejects, run, rejected)
        if folder:
            counters["added"] = publish_append(spark, dst, run, folder)
        elif not appended:
            upsert(spark, transform(good), dst, order=order)
            counters["added"] = True
    return counters


def run_dump(spark: SparkSession, src, reader: str, run: str | None, columns: dict[str, str], **load_options) -> dict:
    """A dump loaded once: unless it is named otherwise, a run is known by the files it reads, so the same dump is the
    same run."""
    return load(spark, READERS[reader](spark, src, columns), columns, run=run or dump_id(spark, src), **load_options)


def replay(spark: SparkSession, corrected: DataFrame, columns: dict[str, str], rejects: str, run: str | None = None, **load_options) -> dict:
    """Corrected rejects through the plan they came from. Each row brings the row_hash of the reject it stands for; rejects
    that are stored now, or are rejected for other reasons, are resolved."""
    run = run or uuid.uuid4().hex
    raw = corrected.select(*dead_letters.raw_schema(columns).names)
    counters = load(spark, raw, columns, rejects=rejects, run=run, **load_options)
    dead_letters.resolve(spark, rejects, run, corrected.select(ROW_HASH), columns)
    return counters
