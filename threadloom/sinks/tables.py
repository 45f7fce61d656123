"""Writing: create if absent, append, published appends, keyed upsert, JDBC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.sinks import versions

RANGE = "id_range"
RANGE_STEP = 1_000_000
# Ids per task and file; a range of the table has several.
SLICE_STEP = 100_000
_NEW = "_new"
_SLICE = "_slice"
_STEP = "step"


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Creates an empty table of folders if there is none; one with other columns is refused."""
    table = versions.current(spark, path)
    names = [f"{f.name} {f.dataType.simpleString()}" for f in schema]
    if not table.number:
        try:
            versions.publish(spark, path, table, {}, columns=names)
        except versions.ConcurrentWrite:
            table = versions.current(spark, path)
    if table.properties.get("columns", names) != names:
        raise ValueError(f"{path} has other columns: {', '.join(table.properties['columns'])}")


def append(df: DataFrame, path: str, max_rows_per_file: int = 0) -> None:
    """Plain append: no key is looked at, a second run adds the rows again."""
    df.write.mode("append").option("maxRecordsPerFile", max_rows_per_file).parquet(path)


def write_unpublished(df: DataFrame, path: str, kind: str = "parquet", max_rows_per_file: int = 0) -> str:
    """The rows in a folder of their own below a table; nobody sees them until the folder is published."""
    folder = versions.new_folder()
    df.write.format(kind).option("maxRecordsPerFile", max_rows_per_file).save(f"{path}/{folder}")
    return folder


def publish_append(spark: SparkSession, path: str, run: str, folder: str) -> bool:
    """Makes a written folder part of a table, as the rows of ``run``. A run that is there already adds nothing: its
    rows stay as they are and the folder goes. Whether it was added."""
    try:
        base = versions.current(spark, path)
        if run not in base.folders:
            versions.publish(spark, path, base, {run: folder})
            return True
    except versions.ConcurrentWrite:  # the same run elsewhere was faster
        pass
    versions.Files(spark, path).remove(folder)
    return False


def read_appended(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", run: str | None = None) -> DataFrame:
    """Rows of all published runs of a table, or of one; runs that were compacted cannot be told apart any more."""
    folders = versions.current(spark, path).folders
    wanted = dict.fromkeys(f for r, f in folders.items() if run in (None, r))
    if run is not None and any(f in wanted for r, f in folders.items() if r != run):
        raise ValueError(f"run {run} of {path} was compacted with others")
    if not wanted:
        return spark.createDataFrame([], schema)
    # Rejected rows have a column of the name that the reader of JSON takes for lines it cannot read.
    reader = spark.read.schema(schema).format(kind).option("columnNameOfCorruptRecord", "_unreadable")
    return reader.load([f"{path}/{f}" for f in wanted])


def compact_appended(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet") -> None:
    """All runs of a table in one folder, with files as large as their tasks make them; each run still counts as there."""
    base = versions.current(spark, path)
    if len(set(base.folders.values())) > 1:
        folder = write_unpublished(read_appended(spark, path, schema, kind), path, kind)
        versions.publish(spark, path, base, dict.fromkeys(base.folders, folder))


def id_range(key: Column, step: int, origin: int = 0) -> Column:
    """Start of the fixed-size id range a key falls into."""
    return F.lit(origin) + F.floor((key - F.lit(origin)) / F.lit(step)).cast("bigint") * F.lit(step)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark ranks within every map task before the shuffle as well, so of a key with
    very many rows only one row per task is moved.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def upsert(spark: SparkSession, new: DataFrame, path: str, key: str = "id", order: list[str] | None = None,
           step: int | None = None) -> None:
    """Insert rows, replacing all columns of those whose key is there already.

    A table holds folders of key ranges under ``data`` and, under ``manifest``, versions of the list of
    folders that count (see ``versions``).  Only the ranges that the new rows touch are read; they are written
    anew beside the old ones, and the new version, one file, makes them count all at once.  A run that fails
    leaves the table as it was, and so does one that another writer was faster than in one of its ranges: it
    raises ``ConcurrentWrite``; writers of different ranges do not hinder each other.  The size of a range
    (``step``, RANGE_STEP at first) belongs to the table; another one is refused, and so are NULL keys.  Of
    several new rows with one key the last by ``order`` is taken; equal rows of that order are told apart by the
    whole row, so the result does not depend on arrival.
    """
    base = versions.current(spark, path)
    known = base.properties.get(_STEP)
    if known and step and step != known:
        raise ValueError(f"{path} has ranges of {known} keys, not {step}")
    step = known or step or RANGE_STEP
    by = [F.col(c).desc_nulls_last() for c in order or []]
    kind = new.schema[key].dataType.simpleString()
    checked = F.coalesce(F.col(key), F.raise_error(F.lit(f"NULL in key {key}")).cast(kind))
    # Ranked before the rows of a slice meet, so that a key with very many rows is cut in every task.
    ranged = latest_per_key(new.withColumn(key, checked), [key], [*by, F.xxhash64(*new.columns)])
    ranged = ranged.withColumn(RANGE, id_range(F.col(key), step))
    folder = versions.new_folder()
    files = versions.Files(spark, path)
    if not base.folders:
        _write_ranges(_sliced(ranged, key), f"{path}/{folder}")
    else:
        # The new rows are used twice, for their ranges and for the merge: write them once, beside the table.
        staged = f"_staged-{folder.rsplit('/', 1)[1]}"
        try:
            ranged.write.parquet(f"{path}/{staged}")
            fresh = spark.read.schema(ranged.schema).parquet(f"{path}/{staged}")
            touched = {str(r[0]) for r in fresh.select(RANGE).distinct().collect()}  # folders of the table
            old = _read_folders(spark, path, {r: f for r, f in base.folders.items() if r in touched}, new.schema)
            both = old.withColumn(_NEW, F.lit(0)).unionByName(fresh.withColumn(_NEW, F.lit(1)))
            # Clustered by slices of ids: ranking within (slice, key) and writing need no second shuffle.
            merged = latest_per_key(_sliced(both, key), [_SLICE, key], [F.col(_NEW).desc()])
            _write_ranges(merged.drop(_NEW), f"{path}/{folder}")
        finally:
            files.remove(staged)
    written = {n.partition("=")[2]: f"{folder}/{n}" for n in files.names(folder) if n.startswith(f"{RANGE}=")}
    versions.publish(spark, path, base, written, **{_STEP: step})


def _read_folders(spark: SparkSession, path: str, folders: dict[str, str], schema: T.StructType) -> DataFrame:
    """Rows of the folders of some ranges."""
    ranged = T.StructType([*schema, T.StructField(RANGE, T.LongType())])
    if not folders:
        return spark.createDataFrame([], ranged)
    by_batch: dict[str, list[str]] = {}
    for folder in folders.values():
        by_batch.setdefault(folder.rsplit("/", 1)[0], []).append(f"{path}/{folder}")
    parts = [spark.read.schema(ranged).option("basePath", f"{path}/{batch}").parquet(*paths)
             for batch, paths in by_batch.items()]
    return reduce(DataFrame.unionByName, parts)


def read_table(spark: SparkSession, path: str, schema: T.StructType, first: int | None = None,
               last: int | None = None, version: int | None = None) -> DataFrame:
    """The last version of an upserted table, or an earlier one; of ranges without keys from ``first`` to ``last``
    nothing is read."""
    table = versions.current(spark, path, version)
    folders = {r: f for r, f in table.folders.items()
               if (first is None or int(r) + table.properties[_STEP] > first) and (last is None or int(r) <= last)}
    return _read_folders(spark, path, folders, schema).drop(RANGE)


def read_changes(spark: SparkSession, path: str, schema: T.StructType, since: int) -> tuple[int, set[int], DataFrame]:
    """What changed in an upserted table after version ``since``: the last version, the starts of the ranges that are
    other than then, and all rows these hold now. Ranges that stayed as they were are not read."""
    table, other, gone = versions.changes(spark, path, since)
    rows = _read_folders(spark, path, {r: table.folders[r] for r in other}, schema).drop(RANGE)
    return table.number, {int(r) for r in other | gone}, rows


def _sliced(df: DataFrame, key: str) -> DataFrame:
    """Neighbouring ids together: a task writes few files, and none of them holds a whole large range."""
    return df.withColumn(_SLICE, id_range(F.col(key), SLICE_STEP)).repartition(_SLICE)


def _write_ranges(df: DataFrame, folder: str) -> None:
    df.drop(_SLICE).write.partitionBy(RANGE).parquet(folder)


def jdbc_write(df: DataFrame, url: str, table: str, batch: int = 1000, connections: int = 8, **options) -> None:
    """Append over JDBC in batches, at most ``connections`` at a time."""
    (df.repartition(connections).write.format("jdbc").mode("append")
     .options(url=url, dbtable=table, batchsize=batch, **options).save())
