"""Exact duplicates by two passes of a Bloom filter, with column expressions only.

Texts are equal when they are the same after deleting space, tab, line feed, vertical tab, form feed and
carriage return; null is the empty text. Of equal texts the row with the most code points in the original
text stays, then the smallest id (null ids last), then any one of rows with the same id.

The first pass sets the bits of all text digests and keeps those that were hit at least twice. In the second
pass a row whose bits are not all among them is surely the only one with its text and passes straight
through; only the others are shuffled, to be grouped by their digest. An empty table gives an empty result;
all texts null or empty are one group; columns of any other name are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.work import Workspace, result

BLANKS = " \t\n\x0b\x0c\r"
BITS_PER_ROW = 16
BROADCAST_BYTES = 64 << 20
_WORD_BYTES = 32  # of a hash table's row: word number, bits, overhead


def normalized(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def _places(sha: Column, bits: int) -> list[Column]:
    """The two bits of a digest: its first and its next 60 bits, cut to the filter's size (a power of two)."""
    return [F.conv(F.substring(sha, start, 15), 16, 10).cast("bigint").bitwiseAND(F.lit(bits - 1)) for start in (1, 16)]


class RepeatedBits:
    """Bits that at least two of the given digests set, as a table of 64-bit words."""

    def __init__(self, work: Workspace, digests: DataFrame, sha: str, broadcast_bytes: int = BROADCAST_BYTES):
        self.bits = 1 << max(16, (digests.count() * BITS_PER_ROW).bit_length())
        hit = (digests.select(F.explode(F.array(*_places(F.col(sha), self.bits))).alias("place"))
               .groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        words = hit.groupBy(F.shiftright("place", 6).alias("word")).agg(
            F.bit_or(_bit(F.col("place"))).alias("set"))
        self.words = work.keep(words, "repeated_bits")
        # Every executor holds the filter if it is small enough; otherwise the same join shuffles.
        self.small = self.words.count() * _WORD_BYTES <= broadcast_bytes

    def mark(self, df: DataFrame, sha: str, flag: str) -> DataFrame:
        """Adds the boolean `flag`: false only if no other row has the digest."""
        words = F.broadcast(self.words) if self.small else self.words
        seen = F.lit(True)
        out = df
        for i, place in enumerate(_places(F.col(sha), self.bits)):
            side = words.select(F.col("word").alias(f"_word{i}"), F.col("set").alias(f"_set{i}"))
            out = out.join(side, F.shiftright(place, 6) == F.col(f"_word{i}"), "left")
            seen = seen & F.coalesce(F.col(f"_set{i}").bitwiseAND(_bit(place)) != 0, F.lit(False))
        return out.withColumn(flag, seen).drop("_word0", "_set0", "_word1", "_set1")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def _order(length: Column, key: Column) -> list[Column]:
    """The smallest of equal texts by this order stays."""
    return [-length, key.isNull(), key]


def mark_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of `df`: the key, keep_id, group_size, kept, text_sha256."""
    spark = df.sparkSession
    with Workspace(spark) as work:
        rows = work.keep(df.select(
            F.col(key).alias("key"), digest(F.col(text)).alias("sha"),
            F.coalesce(F.char_length(F.col(text)), F.lit(0)).alias("length"),
            F.monotonically_increasing_id().alias("row")), "digests")
        marked = work.keep(RepeatedBits(work, rows, "sha", broadcast_bytes).mark(rows, "sha", "maybe"), "marked")
        alone = marked.where("NOT maybe").select(
            F.col("key"), F.col("key").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
            F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
        maybe = marked.where("maybe")
        # As a table, so that a large group's rows can meet its one row in several tasks.
        groups = work.keep(maybe.groupBy("sha").agg(
            F.min(F.struct(*_order(F.col("length"), F.col("key")), "row")).alias("first"),
            F.count(F.lit(1)).alias("group_size")), "groups")
        grouped = maybe.join(groups, "sha").select(
            "key", F.col("first.key").alias("keep_id"), "group_size",
            (F.col("row") == F.col("first.row")).alias("kept"), F.col("sha").alias("text_sha256"))
        return result(spark, alone.unionByName(grouped).withColumnRenamed("key", key))


def drop_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of `df` that stay, with all their columns. Rows that may have a double are reduced to one
    per text within each task before they are shuffled."""
    work = Workspace(df.sparkSession)  # the filter is read when the result is
    whole = df.select(F.struct("*").alias("row"), digest(F.col(text)).alias("sha"),
                      F.coalesce(F.char_length(F.col(text)), F.lit(0)).alias("length"), F.col(key).alias("key"))
    repeated = RepeatedBits(work, df.select(digest(F.col(text)).alias("sha")), "sha", broadcast_bytes)
    marked = repeated.mark(whole, "sha", "maybe")
    alone = marked.where("NOT maybe").select("row")
    kept = marked.where("maybe").groupBy("sha").agg(
        F.min_by("row", F.struct(*_order(F.col("length"), F.col("key")))).alias("row")).select("row")
    return alone.unionByName(kept).select("row.*")
