"""Near-duplicates by SetSketch registers.

A text's set is its distinct shingles of `width` words (see `shingles`); with fewer words the whole sequence is the only
one; a text without words, or null, has an empty set and is linked with nothing. Two texts are linked when
`100 * intersection >= percent * union`, and texts with a chain of links between them are a component.

1. One scan makes each row's set, its fingerprint and its registers. Rows with equal sets are one class from here on.
2. Bands of registers are bucketed. A small bucket gives all its pairs; a large one gives the pairs with its
   first member, which ties most of it together.
3. Pairs whose sizes or jointly estimated similarity are far too low (by six standard deviations) go; the others are
   verified on their full sets.
4. For members of large buckets, the exact rest: two linked sets share one of their rarest shingles, as many
   as may differ. Those that share one are first held against one of them, then, if they are still in different
   components, against each other.

So no group of copies is expanded into its pairs, and nothing is capped. Rows with a null id get a null
component and stay. Repeated rows have one component; kept tells only by the id. Rows are dropped by id and hash of the
text, so of each component the rows with the smallest (id, hash) stay: those with one id and equal texts together. An empty
table gives an empty result; columns of any other name are neither read nor changed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import set_sketch
from threadloom.llm.components import connected
from threadloom.llm.shingles import mix, shingle_sets, text_slices
from threadloom.llm.work import importable, result, tidy, Workspace

BAND, BANDS = 4, 24  # a pair at 0.85 shares no band once in 50 million times
SMALL = 48  # buckets up to this size give all their pairs
BROADCAST_ROWS = 2_000_000  # of three numbers each
FREQUENT = 1 << 15  # shingles of more than SMALL sets that tasks look up by themselves
BANDS_OF_SIZE = 16  # for sizes up to e times as large
_SURE = 6.0  # standard deviations of the estimate


def _batches(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for row, data, ends in text_slices(texts):
        yield (row, *shingle_sets(data, ends, width))


def _sketched(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, elements, ends in _batches(batch.column("text"), width):
                sizes = np.diff(ends, prepend=0)
                regs = set_sketch.registers(elements, ends)
                prints = [hashlib.blake2b(elements[e - n:e].tobytes(), digest_size=16).digest()
                          for n, e in zip(sizes.tolist(), ends.tolist())]
                rows = batch.slice(row, len(ends))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), rows.column("hash"), rows.column("row"), pa.array(sizes.astype(np.int64)),
                     pa.array(prints, pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary())],
                    names=["key", "hash", "row", "n", "print", "registers"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), set_sketch.REGISTERS)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regs = _matrix(batch.column("registers"))[:, :BAND * BANDS].copy().view(np.uint64)
        keys = mix(regs ^ mix(np.arange(BANDS, dtype=np.uint64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1).view(np.int64)),
             pa.array(np.repeat(np.asarray(batch.column("id")), BANDS))], names=["bucket", "id"])


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From members sorted by bucket: all pairs of small buckets; of large ones the pairs with the first member,
    and each member with itself as a mark. Holds at most SMALL members between batches."""
    last, head, large = None, np.empty(0, np.int64), False
    upper = [np.triu_indices(n, 1) for n in range(SMALL + 1)]

    def closed() -> list[np.ndarray]:
        if large or len(head) < 2:
            return []
        i, j = upper[len(head)]
        return [np.stack([head[i], head[j]])]

    def hub(members: np.ndarray) -> np.ndarray:
        return np.concatenate([np.stack([np.full(len(members), head[0]), members]), np.stack([members, members])], axis=1)

    for batch in batches:
        keys, ids = np.asarray(batch.column("bucket")), np.asarray(batch.column("id"))
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
        stops = np.append(starts[1:], len(keys)) if len(keys) else []
        out = []
        for start, stop in zip(starts, stops):
            goes_on = start == 0 and last == keys[0]
            if stop - start == 1 and not goes_on and stop < len(keys):
                if start == 0:
                    out += closed()
                    last = None
                continue  # alone in its bucket
            members = ids[start:stop]
            if not goes_on:
                out += closed() if start == 0 else []
                last, head, large = keys[start], np.empty(0, np.int64), False
            if large:
                out.append(hub(members))
            elif len(head) + len(members) > SMALL:
                members = np.concatenate([head, members])
                head, large = members[:SMALL], True
                out.append(hub(members))
            else:
                head = np.concatenate([head, members])
            if stop < len(keys):
                out += closed()
                last = None
        if out:
            both = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both.min(axis=0)), pa.array(both.max(axis=0))], names=["a", "b"])
    if last is not None and (out := closed()):
        both = np.concatenate(out, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both.min(axis=0)), pa.array(both.max(axis=0))], names=["a", "b"])


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = percent / 100
        least = j - _SURE * (j * (1 - j) / set_sketch.REGISTERS) ** 0.5
        for batch in batches:
            na, nb = np.asarray(batch.column("na")), np.asarray(batch.column("nb"))
            keep = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            batch = batch.filter(pa.array(keep))
            if batch.num_rows:
                found = set_sketch.estimate(_matrix(batch.column("ra")), _matrix(batch.column("rb")), na[keep], nb[keep])
                yield batch.select(["a", "b"]).filter(pa.array(found >= least))
    return run


def _verified(percent: int, width: int):
    def sets(texts: pa.Array) -> Iterator[np.ndarray]:
        for _, elements, ends in _batches(texts, width):
            begin = 0
            for end in ends.tolist():
                yield elements[begin:end]
                begin = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(sets(batch.column("ta")), sets(batch.column("tb"))):
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


def _elements(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, elements, ends in _batches(batch.column("text"), width):
                ids = np.asarray(batch.column("id"))[row:row + len(ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, np.diff(ends, prepend=0))), pa.array(elements.view(np.int64))], names=["id", "x"])
    return run


def _frequent(width: int, ordered: np.ndarray):
    """id, many, frequent: how many of a set's shingles are in `ordered`, and which, in that order."""
    place = np.argsort(ordered)
    values = ordered[place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, elements, ends in _batches(batch.column("text"), width):
                x = elements.view(np.int64)
                at = np.searchsorted(values, x)
                known = np.zeros(len(x), bool)
                inside = at < len(values)
                known[inside] = values[at[inside]] == x[inside]
                owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[known]
                rank = place[at[known]]
                offsets = np.searchsorted(owner, np.arange(len(ends) + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ordered[rank[np.lexsort((rank, owner))]]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, len(ends)), pa.array(np.diff(offsets).astype(np.int64)), found],
                    names=["id", "many", "frequent"])
    return run


class _Classes:
    """Different sets, and what is asked of pairs of them."""

    def __init__(self, work: Workspace, docs: DataFrame, key: str, text: str, percent: int, width: int):
        self.work, self.percent, self.width = work, percent, width
        self.docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"))
        self.key_type = self.docs.schema["key"].dataType.simpleString()
        self.rows = work.keep(self.docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            tidy(_sketched(width)), f"key {self.key_type}, hash bigint, row bigint, n bigint, print binary, registers binary"), "rows")
        self.table = work.keep(self.rows.where("n > 0 AND key IS NOT NULL").groupBy("print").agg(
            F.min("row").alias("id"), F.min(F.struct("key", "hash")).alias("first"), F.any_value("n").alias("n"),
            F.any_value("registers").alias("registers")).select("print", "id", "first.*", "n", "registers"), "classes")

    def likely(self, pairs: DataFrame) -> DataFrame:
        side = self.table.select("id", "n", "registers")
        with_a = pairs.join(side.toDF("a", "na", "ra"), "a")
        with_both = with_a.join(side.toDF("b", "nb", "rb"), "b").select("a", "b", "na", "nb", "ra", "rb")
        return with_both.mapInArrow(tidy(_likely(self.percent)), "a bigint, b bigint")

    def texts(self, ids: DataFrame, name: str) -> DataFrame:
        """One text of each class in `ids` (id)."""
        wanted = self.table.join(ids, "id").select(F.col("key").alias("key_"), F.col("hash").alias("hash_"), "id")
        same = (F.col("key") == F.col("key_")) & (F.col("hash") == F.col("hash_"))
        wanted = self.work.keep(wanted, f"wanted_{name}")
        # So the texts that are not wanted stay where they are, if the list is small enough for every executor.
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
        return self.work.keep(self.docs.join(wanted, same).select(
            "id", "text").dropDuplicates(["id"]), f"texts_{name}")

    def links(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        with_a = pairs.join(texts.toDF("a", "ta"), "a")
        with_both = with_a.join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
        return with_both.mapInArrow(tidy(_verified(self.percent, self.width)), "a bigint, b bigint")


def _bucket_links(classes: _Classes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links found by bands; members of large buckets; the texts of all classes concerned."""
    work = classes.work
    buckets = classes.table.select("id", "registers").mapInArrow(tidy(_band_keys), "bucket bigint, id bigint")
    found = work.keep(buckets.repartition("bucket").sortWithinPartitions("bucket", "id").mapInArrow(
        tidy(_bucket_pairs), "a bigint, b bigint").distinct(), "found")
    large = found.where("a = b").select(F.col("a").alias("id"))
    likely = work.keep(classes.likely(found.where("a < b")), "likely")
    concerned = likely.select(F.explode(F.array("a", "b")).alias("id")).unionByName(large).distinct()
    texts = classes.texts(concerned, "buckets")
    return work.keep(classes.links(likely, texts), "links"), large, texts


def _uncommon(elements: DataFrame, shared: DataFrame, frequent: DataFrame) -> DataFrame:
    """id, df, x: the shingles (x) of a set that others (df) have too, but for the frequent ones."""
    return elements.join(shared.join(F.broadcast(frequent.select("x")), "x", "left_anti"), "x").select("id", "df", "x")


def _rare_shingles(classes: _Classes, large: DataFrame, texts: DataFrame) -> DataFrame:
    """id, n, x, alone, rest: for members of large buckets the rarest shingles, as many as linked sets may differ in
    and one more, so that linked sets share one. `alone`: how many no other has; they come before all and are not
    listed. `rest`: how many shingles are left from this one on. The FREQUENT most frequent ones, those that a large group
    of copies shares, come last in the order of all; a set finds its own among them without a join."""
    work = classes.work
    members = work.keep(large.join(classes.table.select("id", "n"), "id"), "members")
    own = texts.join(members.select("id"), "id").select("id", "text")
    elements = work.keep(own.mapInArrow(tidy(_elements(classes.width)), "id bigint, x bigint"), "elements")
    shared = work.keep(elements.groupBy("x").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    frequent = work.keep(shared.where(F.col("df") > SMALL).orderBy(F.desc("df"), F.desc("x")).limit(FREQUENT), "frequent")
    ordered = np.array([r.x for r in frequent.orderBy("df", "x").collect()], np.int64)
    last = own.mapInArrow(tidy(_frequent(classes.width, ordered)), "id bigint, many bigint, frequent array<bigint>")
    first = _uncommon(elements, shared, frequent).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("df", "x"))).alias("xs")).select("id", "xs.x")
    rare = members.join(last, "id").join(first, "id", "left").withColumn("x", F.coalesce("x", F.array().cast("array<bigint>")))
    may_differ = F.col("n") - F.ceil(F.col("n") * classes.percent / 100) + 1
    alone = F.col("n") - F.size("x") - F.col("many")
    rare = rare.where(may_differ > alone).select(
        "id", "n", F.posexplode(F.slice(F.concat("x", "frequent"), F.lit(1), (may_differ - alone).cast("int"))).alias("at", "x"),
        alone.alias("alone"))
    rare = work.keep(rare.withColumn("rest", F.col("n") - F.col("alone") - F.col("at")).drop("at"), "rare")
    work.forget("elements", "shared", "frequent")
    return rare


def _rest_links(classes: _Classes, links: DataFrame, large: DataFrame, texts: DataFrame) -> DataFrame:
    """Links with the same components as all: those given, and those of members of large buckets, by their rarest
    shingles, exactly."""
    work, percent = classes.work, classes.percent
    rare = _rare_shingles(classes, large, texts)

    def close(n: str, rest: str) -> Column:
        """What is still to come after the first common shingle bounds the intersection."""
        return (100 + percent) * F.least("rest", rest) >= percent * (F.col("n") + F.col(n))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = work.keep(pairs.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct(), name)
        found = classes.links(work.keep(classes.likely(pairs), f"{name}_likely"), texts)
        return work.keep(links.unionByName(found), f"{name}_links")

    # First each shingle's sets with the one of them that has least of its own: copies of one text lie around it.
    hubs = rare.groupBy("x").agg(F.min(F.struct("alone", "id", "n", "rest")).alias("hub")).select("x", "hub.*")
    hubs = hubs.withColumnsRenamed({"id": "b", "n": "nb", "rest": "rest_b", "alone": "alone_b"})
    links = verified(rare.join(work.keep(hubs, "hubs"), "x").where((F.col("id") != F.col("b")) & close("nb", "rest_b")), "hub")
    # Then all that are still apart: those outside a shingle's largest component with all others.
    roots = work.keep(connected(work, links, "hub_roots"), "hub_roots_kept").withColumnRenamed("node", "id")
    rooted = work.keep(rare.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")
    largest = rooted.groupBy("x", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("x").agg(
        F.max_by("root", "c").alias("largest"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("x", "largest")
    outside = rooted.join(largest, "x").where("root <> largest").select(*rooted.columns)
    links = roots.select(F.col("root").alias("a"), F.col("id").alias("b"))  # the same components
    facing = _facing(rooted, outside, percent).unionByName(_facing(outside, rooted, percent))
    return verified(facing.where((F.col("root") != F.col("root_b")) & (F.col("n") <= F.col("nb")) & close("nb", "rest_b")), "rest")


def _facing(some: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs of a shingle (x) that linked sets may have, the set of `some` being no larger than that of `others`. What is
    still to come in a set bounds the sizes that the other may have; so sets that meet in a shingle too late are not
    paired, however many they are, as those with a passage in common that differ elsewhere."""
    def band(n: Column) -> Column:
        return F.floor(F.log(n) * BANDS_OF_SIZE).cast("int")

    def bands(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(band(first), band(last)))

    most = F.floor((100 + percent) * F.col("rest") / percent) - F.col("n")  # elements of the other set
    small = some.where(most >= F.col("n")).select(
        "id", "n", "x", "rest", "root", band(F.col("n")).alias("band"), bands(F.col("n"), most).alias("band_b"))
    least = F.ceil(F.col("n") * percent / 100)
    large = others.where(most >= least).select(
        "x", bands(least, F.least(most, "n")).alias("band"), band(F.col("n")).alias("band_b"), F.col("id").alias("b"),
        F.col("n").alias("nb"), F.col("rest").alias("rest_b"), F.col("root").alias("root_b"))
    return small.join(large, ["x", "band", "band_b"])


def _grouped(work: Workspace, docs: DataFrame, key: str, text: str, percent: int, width: int) -> DataFrame:
    """Per row of `docs`: key, hash, n and `first`, the smallest (key, hash) of its component; null without one."""
    classes = _Classes(work, docs, key, text, percent, width)
    links, large, texts = _bucket_links(classes)
    if not large.isEmpty():
        links = _rest_links(classes, links, large, texts)
    roots = connected(work, links, "roots").withColumnRenamed("node", "id")
    rooted = classes.table.join(roots, "id", "left").select("print", "key", "hash", F.coalesce("root", "id").alias("root"))
    first = rooted.groupBy("root").agg(F.min(F.struct("key", "hash")).alias("first"))
    named = work.keep(rooted.join(first, "root").select("print", "first"), "named")
    grouped = F.when(F.col("key").isNotNull() & (F.col("n") > 0), F.col("first"))
    return classes.rows.select("key", "hash", "n", "print").join(named, "print", "left").select(
        "key", "hash", "n", grouped.alias("first"))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, width: int = 3) -> DataFrame:
    """One row per row of `docs`: the key, n_shingles, component_id (its smallest key), kept."""
    spark = docs.sparkSession
    importable(spark)
    with Workspace(spark) as work:
        return result(spark, _grouped(work, docs, key, text, percent, width).select(
            F.col("key").alias(key), F.col("n").alias("n_shingles"),
            F.coalesce("first.key", "key").alias("component_id")).withColumn(
            "kept", F.col(key).isNull() | F.col(key).eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85,
                         width: int = 3) -> DataFrame:
    """The rows of `docs` that stay, one of each component, with all their columns."""
    spark = docs.sparkSession
    importable(spark)
    with Workspace(spark) as work:
        found = result(spark, _grouped(work, docs, key, text, percent, width).where(
            (F.col("key") != F.col("first.key")) | (F.col("hash") != F.col("first.hash"))).select(
            F.col("key").alias("key_"), F.col("hash").alias("hash_")).distinct())
    whole = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"))
    same = (F.col("key") == F.col("key_")) & (F.col("hash") == F.col("hash_"))
    return whole.join(found, same, "left_anti").select("row.*")
