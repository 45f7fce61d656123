"""Passages of benchmark items in training texts, with column expressions only.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are put in lower case. A window is `width` consecutive words
of an item; an item of fewer words, but not none, is one window. A word of a document inside any occurrence of
a window is hit.

The hashes of all windows of a document are joined with the broadcast set of the benchmark's window hashes in one scan;
what it finds is then verified word by word in the few documents concerned. Only those documents are read again.

A document is known by its id and the hash of its text, so that repeated ids, null ids and repeated rows each
get their own right result. Null and empty texts have no words. An empty benchmark hits nothing, an empty table gives
an empty result, and columns of any other name are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.work import Workspace, result

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
BROADCAST_ROWS = 2_000_000  # of window hashes, or of documents with hits; beyond it the join shuffles


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def benchmark_windows(benchmark: DataFrame, item: str, text: str, width: int = WIDTH) -> DataFrame:
    """window (hash), length (in words), passage, items: one row per different window."""
    split = benchmark.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).where("size(w) > 0")
    length = F.least(F.size("w"), F.lit(width))
    cut = split.select("item", "w", length.alias("length"), F.explode(
        F.sequence(F.lit(1), F.size("w") - length + 1)).alias("at"))
    passages = cut.select("item", "length", F.slice("w", F.col("at"), F.col("length")).alias("w"))
    return passages.select("item", "length", F.array_join("w", " ").alias("passage"),
                           _window_hash(_word_hashes(F.col("w"))).alias("window")).groupBy(
        "window", "length", "passage").agg(F.collect_set("item").alias("items"))


def _word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _window_hash(hashes: Column) -> Column:
    return F.xxhash64(hashes)


def _all_windows(hashes: Column, lengths: list[int]) -> Column:
    """Window hashes of all lengths, one length after the other, after a first entry for the document itself."""
    def of(length: int) -> Column:
        n = F.size(hashes) - (length - 1)
        starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: _window_hash(F.slice(hashes, i, length)))
    return F.concat(F.array(F.lit(0).cast("bigint")), *[of(n) for n in lengths])


def _position(at: Column, n_words: Column, length: Column, lengths: list[int]) -> Column:
    """Number from 1 of a window's first word, from the window's place in the list of all."""
    skipped, out = F.lit(0), F.lit(None).cast("int")
    cases = []
    for n in lengths:
        cases.append((n, at - skipped))
        skipped = skipped + F.greatest(n_words - (n - 1), F.lit(0))
    for n, place in cases:
        out = F.when((length == n) & (place > 0) & (place <= n_words - (n - 1)), place).otherwise(out)
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text",
              item: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row of `docs`: key, hash (of the text), n_words, covered (numbers from 1 of the words hit), items."""
    known = work.keep(benchmark_windows(benchmark, item, item_text, width), "windows")
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect()) or [width]  # at most `width`
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"),
                       _word_hashes(words(F.col(text))).alias("hashes"))
    spread = rows.select("key", "hash", F.size("hashes").alias("n_words"),
                         F.posexplode(_all_windows(F.col("hashes"), lengths)).alias("at", "window"))
    ids = _small(known.select("window", "length").distinct())
    seen = work.keep(spread.join(ids, "window", "left").where("at = 0 OR length IS NOT NULL"), "seen")

    position = _position(F.col("at"), F.col("n_words"), F.col("length"), lengths)
    maybe = seen.where("at > 0").withColumn("position", position).where("position IS NOT NULL")
    maybe = maybe.join(_small(known), ["window", "length"]).groupBy("key", "hash").agg(
        F.collect_set(F.struct("position", "length", "passage", "items")).alias("maybe"))
    maybe = work.keep(maybe, "maybe")
    # Only documents with hits are read to be verified, and their texts are the only ones that may move.
    concerned = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"))
    narrow = _small(maybe.select(F.col("key").alias("key_"), F.col("hash").alias("hash_")))
    same = F.col("key").eqNullSafe(F.col("key_")) & (F.col("hash") == F.col("hash_"))
    concerned = concerned.join(narrow, same, "left_semi").dropDuplicates(["key", "hash"]).select(
        "key", "hash", words(F.col("text")).alias("w"))
    side = maybe.withColumnsRenamed({"key": "key_", "hash": "hash_"})
    true = F.filter("maybe", lambda m: F.array_join(F.slice("w", m["position"], m["length"]), " ") == m["passage"])
    verified = concerned.join(side, same).select("key_", "hash_", true.alias("hits"))
    covered = F.array_distinct(F.flatten(F.transform(
        "hits", lambda m: F.sequence(m["position"], m["position"] + m["length"] - 1))))
    verified = work.keep(verified.select(
        "key_", "hash_", covered.alias("covered"),
        F.array_sort(F.array_distinct(F.flatten("hits.items"))).alias("items")), "verified")
    found = seen.where("at = 0").select("key", "hash", "n_words").join(verified, same, "left")
    empty = F.array().cast("array<int>")
    return found.select("key", "hash", "n_words", F.coalesce("covered", empty).alias("covered"),
                        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """One row per row of `docs`: the key, n_words, n_hit, n_items, items_sha256 (of the sorted, comma-joined
    item ids), contaminated."""
    spark = docs.sparkSession
    with Workspace(spark) as work:
        found = find_hits(docs, benchmark, work, key, **names)
        return result(spark, found.select(
            F.col("key").alias(key), F.col("n_words").cast("bigint").alias("n_words"),
            F.size("covered").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            (F.size("covered") > 0).alias("contaminated")))


def _contaminated(docs: DataFrame, benchmark: DataFrame, key: str, **names) -> DataFrame:
    spark = docs.sparkSession
    with Workspace(spark) as work:
        found = find_hits(docs, benchmark, work, key, **names)
        return _small(result(spark, found.where(F.size("covered") > 0).dropDuplicates(["key", "hash"]).select(
            F.col("key").alias("key_"), F.col("hash").alias("hash_"), "covered")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                      **names) -> DataFrame:
    """The rows of `docs` without any word hit, with all their columns."""
    bad = _contaminated(docs, benchmark, key, text=text, **names).drop("covered")
    whole = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"))
    same = F.col("key").eqNullSafe(F.col("key_")) & (F.col("hash") == F.col("hash_"))
    return whole.join(bad, same, "left_anti").select("row.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of `docs`, the words hit cut out of their texts together with the gap before each."""
    bad = _contaminated(docs, benchmark, key, text=text, **names)
    whole = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"),
                        F.col(text).alias("text"))
    same = F.col("key").eqNullSafe(F.col("key_")) & (F.col("hash") == F.col("hash_"))
    gap = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # in texts as they are, with capitals
    pieces = F.regexp_extract_all("text", F.lit(rf"[{gap}]*[^{gap}]+|[{gap}]+$"), 0)
    rest = F.array_join(F.filter(pieces, lambda p, i: ~F.array_contains("covered", i + 1)), "")
    out = F.when(F.col("covered").isNotNull(), rest).otherwise(F.col("text"))
    return whole.join(bad, same, "left").select(F.col("row").withField(text, out).alias("row")).select("row.*")
