"""Removal of byte strings that occur more than once in a corpus, by a Burrows-Wheeler transform.

Every byte covered by a string of `least` bytes that begins anywhere else too, in the same text or another, is
removed. Texts are UTF-8; null is empty; matches never cross texts and are judged on the input, not on what is left.

1. Each text is cut into runs of places whose strings of `least` bytes share their smallest hash of `PIECE` bytes.
   Equal strings have the same one, so they meet under it, whatever surrounds them; hashes that occur only once end here.
2. The strings of a run, as one segment, go to the task of their hash, equal segments once per task and then once in all.
3. There, `bwt_repeats` searches the segments' transform breadth first for common prefixes up to `least`. A hash with
   more than `CROWDED` bytes of different segments goes to no single task: its strings are counted by their digests.
4. What begins twice is put together for each text.

Equal texts are one from the start: if there are several, they are removed as a whole. A row is known by its key and
the hash of its text, so null and repeated keys and repeated rows get their own right result; texts shorter than
`least` are kept. An empty table gives an empty result, and no other column is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.bwt_repeats import repeated_starts
from threadloom.llm.shingles import BASE, INVERSE, mix, powers, text_slices
from threadloom.llm.work import importable, result, tidy, Workspace

LEAST = 400
PIECE = 128
LONGEST_RUN = 2048  # longer runs, of periodic text, are cut
TOGETHER = 1 << 19  # bytes of segments that one transform takes, besides those of its last hash, which are not parted
CROWDED = 1 << 19  # a hash with more bytes of different segments is searched by digests instead
_RAW = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _runs(data: np.ndarray, ends: np.ndarray, least: int, piece: int) -> tuple[np.ndarray, ...]:
    """(row, first place, places, hash, whether the hash occurs once only in it) of each run of these texts."""
    n, window = len(data), least - piece + 1
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, bool))
    if n < least:
        return none
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_RAW[data] * powers(BASE, n))])
    pieces = mix((sums[piece:] - sums[:-piece]) * powers(INVERSE, n)[:n - piece + 1])
    # Smallest of each window: of the rest of its block and of the beginning of the next.
    size = -(-len(pieces) // window) * window
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(pieces)] = pieces
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    places = n - least + 1
    smallest = np.minimum(behind[:places], ahead[window - 1:window - 1 + places])
    row_of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    valid = np.arange(places) + least <= ends[row_of[:places]]
    at = np.flatnonzero(valid)
    if not len(at):
        return none
    own = smallest[at]
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1])])
    run = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    new |= (np.arange(len(at)) - begin[run]) % LONGEST_RUN == 0
    begin = np.flatnonzero(new)
    first, value = at[begin], own[begin]
    count = np.diff(np.append(begin, len(at)))
    once = np.array([(pieces[f:f + c + window - 1] == v).sum() < 2 for f, c, v in zip(first.tolist(), count.tolist(), value)], bool)
    row = row_of[first]
    starts = np.concatenate([[0], ends[:-1]])
    return row, first - starts[row], count, value, once


def _scanned(least: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, ends in text_slices(batch.column("text")):
                rows = batch.slice(start, len(ends))
                row, first, count, value, once = _runs(data, ends, least, piece)
                offsets = pa.array(np.searchsorted(row, np.arange(len(ends) + 1)).astype(np.int32))
                texts = [data[b:e].tobytes() for b, e in zip([0, *ends[:-1].tolist()], ends.tolist())]

                def listed(values: np.ndarray) -> pa.Array:
                    return pa.ListArray.from_arrays(offsets, pa.array(values))

                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), rows.column("hash"), rows.column("row"),
                     pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                     listed(value.view(np.int64)), listed(first.astype(np.int32)), listed(count.astype(np.int32)), listed(once)],
                    names=["key", "hash", "row", "n_bytes", "sha", "value", "first", "places", "once"])
    return run


def _segments(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = (batch.column("text")[i].as_py() or "").encode()
                values, firsts, places = (batch.column(c)[i].values.to_pylist() for c in ("value", "first", "places"))
                parts = [text[f:f + p + least - 1] for f, p in zip(firsts, places)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("id")[i].as_py()] * len(parts), pa.int64()), pa.array(values, pa.int64()),
                     pa.array(firsts, pa.int32()),
                     pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in parts], pa.binary()),
                     pa.array(parts, pa.binary())], names=["id", "value", "first", "segment", "bytes"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in run(batches):
            held.append(b)
            size += b.nbytes
            if size > TOGETHER:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return joined


def _as_ranges(keys: list[bytes], places: list[np.ndarray]) -> pa.RecordBatch:
    """Sorted places of each segment as ranges, both ends inclusive."""
    low, high = [], []
    for starts in places:
        edge = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
        low.append(starts[edge].astype(np.int32))
        high.append((starts[np.append(edge[1:], len(starts)) - 1] if len(starts) else starts).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(low, pa.list_(pa.int32())), pa.array(high, pa.list_(pa.int32()))],
        names=["segment", "low", "high"])


def _strings(least: int):
    """The digest of every string of `least` bytes in a segment; `n` is 2 where the segment occurs again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part, many in zip(*(batch.column(c).to_pylist() for c in ("segment", "bytes", "several"))):
                digests = [hashlib.blake2b(part[i:i + least], digest_size=16).digest() for i in range(len(part) - least + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(digests), pa.binary()), pa.array(np.arange(len(digests), dtype=np.int32)),
                     pa.array(digests, pa.binary()), pa.array(np.full(len(digests), 1 + many, np.int32))],
                    names=["segment", "place", "string", "n"])
    return run


def _listed_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _as_ranges(batch.column("segment").to_pylist(), [np.sort(p.values.to_numpy()) for p in batch.column("places")])


def _crowded_searched(work: Workspace, different: DataFrame, least: int) -> DataFrame:
    """As `_searched`, of segments under any number of hashes, with no more than a string's own places in one group."""
    strings = work.keep(different.mapInArrow(
        tidy(_strings(least)), "segment binary, place int, string binary, n int"), "strings")
    again = strings.groupBy("string").agg(F.sum("n").alias("n")).where("n > 1").select("string")
    places = strings.select("segment", "place", "string").join(again, "string").groupBy("segment").agg(
        F.collect_list("place").alias("places"))
    return places.mapInArrow(tidy(_listed_ranges), "segment binary, low array<int>, high array<int>")


def _searched(least: int):
    """From segments sorted by hash: the places of each, as ranges, where a repeated string begins."""
    def found(keys: list[bytes], parts: list[bytes], several: list[bool]) -> pa.RecordBatch:
        return _as_ranges(keys, [np.arange(len(part) - least + 1) if many else starts
                                 for part, many, starts in zip(parts, several, repeated_starts(parts, least))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, several, size, last = [], [], [], 0, None
        for batch in batches:
            for value, key, part, many in zip(*(batch.column(c).to_pylist() for c in ("value", "segment", "bytes", "several"))):
                if size >= TOGETHER and value != last:
                    yield found(keys, parts, several)
                    keys, parts, several, size = [], [], [], 0
                keys.append(key)
                parts.append(part)
                several.append(many)
                size, last = size + len(part), value
        if keys:
            yield found(keys, parts, several)
    return run


def _cut(least: int):
    """Merged spans of each text and what is left of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, shas, removed = [], [], []
            for i in range(batch.num_rows):
                text = (batch.column("text")[i].as_py() or "").encode()
                low, high = (np.asarray(batch.column(c)[i].values).astype(np.int64) for c in ("low", "high"))
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, low, 1)
                np.add.at(edge, high + least, -1)
                gone = np.diff(np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]).astype(np.int8))
                begin, end = np.flatnonzero(gone == 1), np.flatnonzero(gone == -1)
                spans.append([{"start": b, "stop": e} for b, e in zip(begin.tolist(), end.tolist())])
                edges = [0, *np.stack([begin, end], axis=1).reshape(-1).tolist(), len(text)]
                left = b"".join(text[b:e] for b, e in zip(edges[::2], edges[1::2]))
                shas.append(hashlib.sha256(left).digest())
                removed.append(len(text) - len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                 pa.array(removed, pa.int64()), pa.array(shas, pa.binary())], names=["id", "spans", "n_removed", "kept_sha"])
    return run


def find_spans(docs: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text", least: int = LEAST,
               piece: int = PIECE) -> DataFrame:
    """Per row of `docs`: key, hash, n_bytes, spans (bytes to remove), n_removed, kept_sha."""
    importable(docs.sparkSession)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"))
    kind = texts.schema["key"].dataType.simpleString()
    rows = work.keep(texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        tidy(_scanned(least, piece)), f"key {kind}, hash bigint, row bigint, n_bytes bigint, sha binary, value array<bigint>, "
        "first array<int>, places array<int>, once array<boolean>"), "rows")
    classes = rows.where(F.col("n_bytes") >= least).groupBy("sha").agg(
        F.count(F.lit(1)).alias("copies"), F.min("row").alias("id"))
    classes = work.keep(classes, "classes")
    runs = rows.join(classes.select("id"), F.col("row") == F.col("id")).select(
        "id", F.inline(F.arrays_zip("value", "first", "places", "once")))
    runs = work.keep(runs, "runs")
    again = runs.groupBy("value").agg(F.sum(F.when(F.col("once"), 1).otherwise(2)).alias("n")).where("n > 1").select("value")
    wanted = runs.join(again, "value").groupBy("id").agg(F.collect_list(F.struct("value", "first", "places")).alias("r"))
    wanted = wanted.join(rows.select(F.col("row").alias("id"), F.col("key").alias("key_"), F.col("hash").alias("hash_")), "id")
    wanted = work.keep(wanted.select("id", "key_", "hash_", "r.value", "r.first", "r.places"), "wanted")
    work.forget("runs")
    same = F.col("key").eqNullSafe(F.col("key_")) & (F.col("hash") == F.col("hash_"))
    held = work.keep(texts.join(wanted, same).select("id", "text", "value", "first", "places").dropDuplicates(["id"]), "held")
    segments = work.keep(held.mapInArrow(
        tidy(_segments(least)), "id bigint, value bigint, first int, segment binary, bytes binary"), "segments")
    different = segments.groupBy("value", "segment").agg(
        F.any_value("bytes").alias("bytes"), (F.count(F.lit(1)) > 1).alias("several"))
    crowded = segments.groupBy("value", "segment").agg(F.any_value(F.length("bytes")).alias("size")).groupBy("value").agg(
        F.sum("size").alias("size")).where(F.col("size") > CROWDED).select("value")
    crowded = F.broadcast(work.keep(crowded, "crowded"))  # at most one hash for CROWDED bytes
    searched = different.join(crowded, "value", "left_anti").repartition("value").sortWithinPartitions("value").mapInArrow(
        tidy(_searched(least)), "segment binary, low array<int>, high array<int>").where("size(low) > 0")
    if not crowded.isEmpty():
        searched = searched.unionByName(_crowded_searched(work, different.join(crowded, "value", "left_semi"), least))
    searched = work.keep(searched.select("segment", F.inline(F.arrays_zip("low", "high"))), "searched")
    begins = segments.select("id", "first", "segment").join(searched, "segment").groupBy("id").agg(
        F.collect_list(F.col("first") + F.col("low")).alias("low"), F.collect_list(F.col("first") + F.col("high")).alias("high"))
    span = "array<struct<start:int,stop:int>>"
    cut = work.keep(held.select("id", "text").join(begins, "id").mapInArrow(
        tidy(_cut(least)), f"id bigint, spans {span}, n_removed bigint, kept_sha binary"), "cut")
    work.forget("held", "segments", "strings")
    whole = F.col("copies") > 1
    known = classes.join(cut, "id", "left").where(whole | F.col("n_removed").isNotNull()).select(
        "sha", "copies", "spans", "n_removed", "kept_sha")
    all_bytes = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))
    return rows.select("key", "hash", "n_bytes", "sha").join(known, "sha", "left").select(
        "key", "hash", "n_bytes",
        F.when(whole, all_bytes).otherwise(F.coalesce("spans", F.array().cast(span))).alias("spans"),
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.unhex(F.sha2(F.lit(""), 256))).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha"))


def report(docs: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """One row per row of `docs`: the key, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    with Workspace(spark) as work:
        found = find_spans(docs, work, key, **names)
        return result(spark, found.select(
            F.col("key").alias(key), "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
            F.lower(F.hex("kept_sha")).alias("kept_sha256")))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of `docs`, the repeated bytes cut out of their texts; parts of characters at a cut go too."""
    spark = docs.sparkSession
    with Workspace(spark) as work:
        found = result(spark, find_spans(docs, work, key, text=text, **names).where("n_removed > 0").select(
            F.col("key").alias("key_"), F.col("hash").alias("hash_"), "n_bytes", "spans").dropDuplicates(["key_", "hash_"]))
    whole = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"))
    same = F.col("key").eqNullSafe(F.col("key_")) & (F.col("hash") == F.col("hash_"))
    data = F.encode(F.col(f"row.`{text}`"), "UTF-8")
    stops = F.concat(F.array(F.lit(0)), F.col("spans.stop"))
    starts = F.concat(F.col("spans.start"), F.array(F.col("n_bytes").cast("int")))
    kept = F.transform(F.arrays_zip(stops.alias("a"), starts.alias("b")), lambda s: F.try_validate_utf8(
        F.regexp_replace(F.decode(F.substr(data, s["a"] + 1, s["b"] - s["a"]), "UTF-8"), "�", "")))
    out = F.when(F.col("spans").isNotNull(), F.array_join(kept, "")).otherwise(F.col(f"row.`{text}`"))
    return whole.join(found, same, "left").select(F.col("row").withField(text, out).alias("row")).select("row.*")
