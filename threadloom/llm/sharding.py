"""Rows on shards by a consistent-hash ring with bounded loads, with column expressions only.

Each shard has many virtual nodes on a ring of cells; a row's key falls into a cell, whose home is the next
virtual node clockwise. No shard takes more rows than its bound: keys of a full shard continue clockwise to
the next shard with room. With the tight bound used here (all rows divided by the shards, the first shards one
more) the counts differ by one at most, whatever the keys; a row leaves its home only where that is full.

Only counts per bin are seen by the driver, and the number of bins is a parameter. A bin is a cell and a salt
of key and text, so that many rows with one key are numbered by several tasks. Nothing depends on how the rows are dealt
out: the same rows get the same shards and slots in any number of files. Rows with null keys have one cell; null texts
have size 8, texts of any length are only measured and hashed; equal rows are in one bin and get slots of their own. An
empty table gives an empty result; columns of other names are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.work import Workspace, result

CELLS, SALTS, VIRTUAL_NODES = 4096, 8, 64


def home_of_cells(shards: int, cells: int = CELLS, virtual_nodes: int = VIRTUAL_NODES) -> list[int]:
    """The shard of each cell: that of the first virtual node at or after it, going round."""
    at: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            place = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8]) % cells
            if at.get(place, shard) >= shard:
                at[place] = shard
    homes, shard = [0] * cells, at[min(at)]
    for cell in reversed(range(cells)):
        shard = at.get(cell, shard)
        homes[cell] = shard
    return homes


def bounds(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def place_bins(counts: dict[tuple[int, int], int], shards: int, cells: int = CELLS) -> list[tuple]:
    """(cell, salt, first, last, shard, slot of the first) for ranges of each bin's rows, numbered from 1.
    Every shard first takes from its own cells; what is left continues clockwise."""
    homes = home_of_cells(shards, cells)
    room = bounds(sum(counts.values()), shards)
    used = [0] * shards
    placed, left = [], []

    def take(cell: int, salt: int, first: int, last: int, shard: int) -> int:
        n = min(last - first + 1, room[shard] - used[shard])
        if n:
            placed.append((cell, salt, first, first + n - 1, shard, used[shard]))
            used[shard] += n
        return first + n

    for (cell, salt), n in sorted(counts.items()):
        first = take(cell, salt, 1, n, homes[cell])
        if first <= n:
            left.append((cell, salt, first, n))
    for cell, salt, first, last in left:
        at = cell
        while first <= last:
            at = (at + 1) % cells
            first = take(cell, salt, first, last, homes[at])
    return placed


def shard_rows(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
               cells: int = CELLS, salts: int = SALTS) -> DataFrame:
    """One row per row: the key, size (bytes of the text and 8), text_crc32, law, shard, slot, grown_shard."""
    spark = df.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    with Workspace(spark) as work:
        rows = work.keep(df.select(
            F.col(key).alias("key"), (F.octet_length(whole) + F.lit(8).cast("bigint")).alias("size"),
            F.crc32(whole).alias("text_crc32"), F.xxhash64(F.col(text)).alias("hash")), "rows")
        binned = rows.select(
            "*", F.pmod(F.xxhash64("key"), F.lit(cells)).cast("int").alias("cell"),
            F.pmod(F.xxhash64("key", "hash"), F.lit(salts)).cast("int").alias("salt"))
        counts = {(r["cell"], r["salt"]): r["count"] for r in binned.groupBy("cell", "salt").count().collect()}
        ranges = F.broadcast(spark.createDataFrame(
            place_bins(counts, shards, cells),
            "cell int, salt int, first bigint, last bigint, shard int, slot_of_first bigint"))
        number = F.row_number().over(Window.partitionBy("cell", "salt").orderBy("key", "hash", "size", "text_crc32"))
        numbered = binned.withColumn("number", number.cast("bigint"))
        sharded = numbered.join(ranges, ["cell", "salt"]).where("number BETWEEN first AND last")
        return result(spark, sharded.select(
            F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            (F.col("slot_of_first") + F.col("number") - F.col("first")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard")))
