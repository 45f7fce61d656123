"""Questions and answers out of the feature table, by post type and id range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.schemas import POSTS_FEATURES, SPLIT_COLUMNS
from threadloom.sinks import versions
from threadloom.sinks.tables import RANGE, id_range, publish_append, read_changes

QUESTION, ANSWER = 1, 2
# First id, id that the last range has to reach, ids per range.
MIN_ID, MAX_ID, STEP = 4, 78_253_176, 100_000


def last_id(min_id: int = MIN_ID, max_id: int = MAX_ID, step: int = STEP) -> int:
    """End of the last whole range."""
    return min_id + ((max_id - min_id) // step + 1) * step - 1


def of_type(features: DataFrame, post_type: int, first: int | None = None, last: int | None = None) -> DataFrame:
    """Posts of one type, without the body, with ids from `first` to `last` if given. All tests reach the scan."""
    out = features.where(F.col("posttypeid") == F.lit(post_type).cast("tinyint"))
    if first is not None:
        out = out.where(F.col("id") >= first)
    if last is not None:
        out = out.where(F.col("id") <= last)
    return out.select(*SPLIT_COLUMNS)


def with_range(posts: DataFrame, min_id: int = MIN_ID, step: int = STEP) -> DataFrame:
    return posts.withColumn("range_start", id_range(F.col("id"), step, min_id))


def split_posts(features: DataFrame, first: int | None = None, last: int | None = None) -> tuple[DataFrame, DataFrame]:
    return tuple(of_type(features, t, first, last) for t in (QUESTION, ANSWER))


SPLIT_SCHEMA = T.StructType([f for f in POSTS_FEATURES if f.name in SPLIT_COLUMNS])
_TARGET, _SOURCE = "_target", "split_version"


def _write_once(spark: SparkSession, features: DataFrame, targets: dict[int, str], first: int | None, last: int | None,
                by: list[str]) -> dict[int, str]:
    """One scan and one write for both targets; then the folder of each is moved to its table. Where they are now."""
    wanted = features.where(F.col("posttypeid").isin(*targets))
    if first is not None:
        wanted = wanted.where(F.col("id") >= first)
    if last is not None:
        wanted = wanted.where(F.col("id") <= last)
    staging, folder = versions.Files(spark, targets[QUESTION]), versions.new_folder()
    staged = f"_split-{folder.rsplit('/', 1)[1]}"
    try:
        (wanted.select(*SPLIT_COLUMNS, *by, F.col("posttypeid").cast("int").alias(_TARGET))
         .write.partitionBy(_TARGET, *by).parquet(f"{staging.root}/{staged}"))
        there = [t for t in targets if staging.exists(f"{staged}/{_TARGET}={t}")]
        for kind in there:
            staging.move(f"{staged}/{_TARGET}={kind}", versions.Files(spark, targets[kind]), folder)
        return dict.fromkeys(there, folder)
    finally:
        staging.remove(staged)


def run_split(features: DataFrame, questions: str, answers: str, first: int | None = None, last: int | None = None,
              run: str | None = None) -> None:
    """Questions and answers out of one scan, appended to their tables; of a named ``run`` only once."""
    spark, targets = features.sparkSession, {QUESTION: questions, ANSWER: answers}
    for kind, folder in _write_once(spark, features, targets, first, last, []).items():
        publish_append(spark, targets[kind], run or folder, folder)


def split_changes(spark: SparkSession, features: str, questions: str, answers: str, first: int | None = None,
                  last: int | None = None) -> set[int]:
    """Brings both tables up to date with an upserted feature table. Only id ranges that changed since the version they
    were split from are read, and replaced as a whole; those ranges are returned. Run twice, it does nothing.
    """
    targets = {QUESTION: questions, ANSWER: answers}
    tables = {kind: versions.current(spark, path) for kind, path in targets.items()}
    since = min(t.properties.get(_SOURCE, 0) for t in tables.values())
    try:
        number, ranges, rows = read_changes(spark, features, POSTS_FEATURES, since)
    except ValueError:  # that version is gone: all of it
        number, ranges, rows = read_changes(spark, features, POSTS_FEATURES, 0)
        ranges |= {int(r) for t in tables.values() for r in t.folders}
    if number == since:
        return set()
    step = versions.current(spark, features).properties.get("step", STEP)
    folders = _write_once(spark, rows.withColumn(RANGE, id_range(F.col("id"), step)), targets, first, last, [RANGE]) if ranges else {}
    for kind, path in targets.items():
        folder = folders.get(kind)
        names = versions.Files(spark, path).names(folder) if folder else []
        added = {n.partition("=")[2]: f"{folder}/{n}" for n in names if n.startswith(f"{RANGE}=")}
        gone = {str(r) for r in ranges if str(r) in tables[kind].folders} - set(added)
        versions.publish(spark, path, tables[kind], added, gone, step=step, **{_SOURCE: number})
    return ranges
