"""Typing with rejection: every row gets a reason, or none."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.schemas import CORRUPT
from threadloom.session import remove_folder, work_folder

REASON = "error_reason"


def typed(columns: dict[str, str], name: str) -> Column:
    return F.col(name).try_cast(columns[name]) if columns[name] != "string" else F.col(name)


def reject_reason(columns: dict[str, str], key: str = "Id",
                  lengths: list[tuple[str, Column, int]] | None = None) -> Column:
    """All reasons why a raw row cannot be stored, joined by ``;``; NULL if there is none."""
    present = [c for c in columns if columns[c] != "string"]
    reasons = [F.when(F.col(c).isNotNull() & typed(columns, c).isNull(), F.lit(f"bad {c}")) for c in present]
    reasons.insert(0, F.when(F.col(key).isNull() & F.col(CORRUPT).isNull(), F.lit(f"missing {key}")))
    reasons.insert(0, F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed row")))
    for name, value, limit in lengths or []:
        reasons.append(F.when(F.length(value) > limit, F.lit(f"long {name}")))
    return F.nullif(F.concat_ws(";", *reasons), F.lit(""))


def rejected(df: DataFrame, reason: Column) -> DataFrame:
    """Raw rows that are not stored, with their reason; ready for ``write.json``."""
    return df.withColumn(REASON, reason).where(F.col(REASON).isNotNull())


_COUNTERS = {
    "processed": lambda reason: F.count(F.lit(1)),
    "stored": lambda reason: F.count_if(reason.isNull()),
    "rejected": lambda reason: F.count_if(reason.isNotNull()),
}


def run_counters(raw: DataFrame, reason: Column) -> DataFrame:
    """Rows read, stored and rejected, by a scan of its own that computes no features."""
    return raw.select(reason.alias(REASON)).agg(*[f(F.col(REASON)).alias(n) for n, f in _COUNTERS.items()])


@contextmanager
def staged(spark: SparkSession, raw: DataFrame, reason: Column) -> Iterator[tuple[DataFrame, DataFrame, dict]]:
    """Raw rows read and parsed once: those to store, those rejected (with their reason), and the counters.

    The rows are written to the work folder with their reason, so that whatever is made of them later reads them there;
    they are counted as they are written.
    """
    began, folder = time.monotonic(), work_folder(spark, "raw-rows")
    try:
        marked, seen = raw.withColumn(REASON, reason), Observation()
        marked.observe(seen, *[f(F.col(REASON)).alias(n) for n, f in _COUNTERS.items()]).write.parquet(folder)
        counts, rows = dict(seen.get), spark.read.schema(marked.schema).parquet(folder)
        yield rows.where(F.col(REASON).isNull()).drop(REASON), rows.where(F.col(REASON).isNotNull()), counts
        counts["seconds"] = round(time.monotonic() - began, 3)
    finally:
        remove_folder(spark, folder)


def error_summary(rejects: DataFrame, order: str = "Id", examples: int = 50) -> DataFrame:
    """Per reason: number of rows and the first ``examples`` of them as JSON.

    The ranking is cut to ``examples`` rows per reason in every map task before the
    shuffle, so one reason that holds most rows does not load one task.
    """
    row = F.to_json(F.struct(*[c for c in rejects.columns if c != REASON]))
    first = (
        rejects.select(REASON, F.col(order).alias("_order"), row.alias("_row"))
        .withColumn("_n", F.row_number().over(Window.partitionBy(REASON).orderBy("_order", "_row")))
        .where(F.col("_n") <= examples)
        .groupBy(REASON)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_row"))), lambda x: x["_row"]).alias("examples")))
    counts = rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(first, REASON).select(REASON, "rows", "examples")
