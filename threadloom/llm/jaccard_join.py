"""Documents whose sets of word n-grams are alike, by T-occurrence search with DivideSkip.

Lower-cases A-Z and takes words `[^\\x20\\x09-\\x0D]+`. A document's set is its distinct shingles of `width` words; with fewer
words the whole sequence is the only one, without words or text it is empty and linked with nothing. Two documents link when
`100 * intersection >= percent * union`; a component is what a chain of links ties together.

A set of n must share T = ceil(percent * n / 100) shingles with any it links to. Each shingle has an inverted list, and
short lists are merged while long ones are only probed:

1. Rows with equal sets are one class, searched once. Of each class its head is kept, the first AHEAD * (n - T + TAU)
   shingles by hash; whole sets are made only of classes that need them in steps 2 and 4.
2. All sets are put in one order of shingles, those with long lists last, otherwise by hash. Which are long is found in
   rounds: a set's first n - T + TAU shingles in that order are listed, and those with more than SHORT entries move
   to the end. Any order gives the same links; so at most FREQUENT of them, the most frequent, are sent to the tasks.
3. Under one order two linked sets share TAU (fewer for tiny sets) of their first n - T + TAU shingles. Each set merges
   its lists with a heap, skipping ahead in lists that cannot make up TAU occurrences.
4. The candidates' other shingles, those of long lists, are probed by binary search in the candidate's set, which gives
   the whole intersection. For every set the candidate with most occurrences goes first; candidates already in
   its component are not looked at again.
5. Lists that are still long, of large groups of near copies, are not merged. All their sets are probed with one of
   them. Lists that are not tied by that and have sets in common are a group, and its sets outside its largest component
   are counted against all of it, block by block: a block holds about BLOCK sets of like size, and a task two blocks. So no link between different sets is lost and none is capped. Many
   sets that share most shingles without being linked stay quadratic in their number.

Rows with a null id get a null component. Repeated rows have one component; an id with two texts belongs to both
components, each row to that of its text. Empty tables give empty results; columns of any other name are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.components import connected
from threadloom.llm.shingles import shingle_sets, text_slices
from threadloom.llm.work import Workspace, dealt, importable, result, tidy

TAU = 3
SHORT, LONG = 32, 128  # entries: above SHORT a shingle is moved to the end, above LONG its list is not merged
ROUNDS, AHEAD = 12, 2  # rounds of moving shingles, and how many prefixes ahead a round looks
FREQUENT = 1_000_000  # shingles known to every task, eight bytes each
SALT = 16
BROADCAST_ROWS = 2_000_000  # of three numbers each
HUB_ROUNDS, BLOCK = 1, 400  # rounds of single sets; sets in a block
ENTRIES, NUMBERS, SETS, PAIRS = 250_000, 100_000, 4000, 4  # a task's rows of lists, of some numbers, of whole sets, and pairs of blocks


def required(n, percent: int):
    """Shingles that a set of n shares with any it links to."""
    return -(-n * percent // 100)


def prefix_length(n, percent: int):
    need = required(n, percent)
    return n - need + np.minimum(TAU, need)


# ---- sets -----------------------------------------------------------------------------

def _sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(first row, sizes, sorted sets) for runs of rows."""
    for row, data, ends in text_slices(texts):
        elements, ends = shingle_sets(data, ends, width)
        yield row, np.diff(ends, prepend=0).astype(np.int64), [elements[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _heads(percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, n, sets in _sets(batch.column("text"), width):
                rows = batch.slice(row, len(n))
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                heads = [s[:AHEAD * k].tobytes() for s, k in zip(sets, prefix_length(n, percent))]
                yield pa.RecordBatch.from_arrays(
                    [*map(rows.column, ("key", "hash", "row")), pa.array(n), pa.array(prints, pa.binary()), pa.array(heads, pa.binary())],
                    names=["key", "hash", "row", "n", "print", "head"])
    return run


def _whole(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, n, sets in _sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, len(n)), pa.array(n), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "n", "elements"])
    return run


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array `among`."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


# ---- order and lists ------------------------------------------------------------------

def _ordered(elements: np.ndarray, late: np.ndarray) -> np.ndarray:
    return np.concatenate([elements[~late], elements[late]])


def _listed(ids: np.ndarray, n: np.ndarray, xs: list[np.ndarray], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    if xs:
        k = np.array([*map(len, xs)])
        at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        x = np.concatenate(xs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)), pa.array(np.repeat(ids, k)), pa.array(np.repeat(n, k).astype(np.int32)),
             pa.array(at.astype(np.int32)), pa.array(_member(x, frequent))], names=["x", "id", "n", "at", "late"])


def _prefixes(batch: pa.RecordBatch, percent: int, frequent: np.ndarray) -> Iterator[np.ndarray | None]:
    """Of each set its first shingles in the order with `frequent` last; None where the part of it that is there does
    not tell."""
    n = np.asarray(batch.column("n"))
    for e, size, k in zip(_arrays(batch.column("elements")), n, prefix_length(n, percent)):
        late = _member(e, frequent)
        known = len(e) == size or np.count_nonzero(~late) >= k
        yield np.concatenate([e[~late], e[late]])[:k] if known else None


def _entries(percent: int, frequent: np.ndarray):
    """x, id, n, at, late: those first shingles and whether they are among the last of the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = [*_prefixes(batch, percent, frequent)]
            told = np.array([x is not None for x in xs], bool)
            if told.any():
                x = np.concatenate([x for x in xs if x is not None])
                k = np.array([len(x) for x in xs if x is not None])
                at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)), pa.array(np.repeat(np.asarray(batch.column("id"))[told], k)),
                     pa.array(np.repeat(np.asarray(batch.column("n"))[told], k).astype(np.int32)), pa.array(at.astype(np.int32)),
                     pa.array(_member(x, frequent))], names=["x", "id", "n", "at", "late"])
    return run


def _untold(percent: int, frequent: np.ndarray):
    """id: classes whose heads do not tell their first shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            untold = [x is None for x in _prefixes(batch, percent, frequent)]
            yield batch.select(["id"]).filter(pa.array(untold, pa.bool_()))
    return run


def _entering(percent: int, before: np.ndarray, new: np.ndarray):
    """x: of sets that had shingles in their prefix which are moved to the end now, what may follow instead."""
    after = np.sort(np.concatenate([before, new]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for e, k in zip(_arrays(batch.column("elements")), prefix_length(np.asarray(batch.column("n")), percent)):
                seen = e[~_member(e, before)][:k]
                moved = _member(seen, new)
                if moved.any():
                    found.append(e[~_member(e, after)][np.count_nonzero(~moved):AHEAD * k])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["x"])
    return run


def _lists(percent: int, longest: int):
    """From entries sorted by shingle and id: q, n, ids: for each entry the later ones of its list that may link to it by
    their sizes and by the places of the shingle in both. A list of more than `longest` is only named, as q without n. Holds one
    list between batches, of a longer one its last batch."""
    names = ["x", "id", "n", "at"]

    def of(x, id, n, at) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        lengths = np.diff(np.append(starts, len(x)))
        named = x[starts[lengths > longest]]
        yield pa.RecordBatch.from_arrays([pa.array(named), pa.nulls(len(named), pa.int64()), pa.array([[]] * len(named), pa.list_(pa.int64()))],
                                         names=["q", "n", "ids"])
        for size in np.unique(lengths[(lengths > 1) & (lengths <= longest)]).tolist():
            rows = starts[lengths == size][:, None]
            i, j = np.triu_indices(size, 1)
            for part in np.array_split(rows, max(1, len(rows) * len(i) >> 18)):
                a, b = part + i, part + j
                most = np.minimum(at[a], at[b]) + 1 + np.minimum(n[a] - at[a], n[b] - at[b]) - 1
                fits = (100 + percent) * most >= percent * (n[a] + n[b])
                fits &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
                a, b = a[fits], b[fits]
                if len(a):
                    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(id[a[first]]), pa.array(n[a[first]].astype(np.int64)),
                         pa.ListArray.from_arrays(pa.array(np.append(first, len(a)).astype(np.int32)), pa.array(id[b]))],
                        names=["q", "n", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        for batch in batches:
            columns = [np.concatenate([h, np.asarray(batch.column(c))]) for h, c in zip(held, names)]
            x = columns[0]
            if len(x):
                last = int(np.flatnonzero(x != x[-1])[-1]) + 1 if (x != x[-1]).any() else 0
                if last:
                    yield from of(*[c[:last] for c in columns])
                held = [c[last:][:longest + 1] for c in columns]
        yield from of(*held) if len(held[0]) else ()
    return run


# ---- merging --------------------------------------------------------------------------

def merge_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(id, lists that have it) for ids in at least `least` of the sorted lists. Where too few lists have the smallest id,
    the next ones are popped as well and all of them skip to what the heap has then, as nothing before can do."""
    heap, at = [(ids[0], i) for i, ids in enumerate(lists)], [0] * len(lists)
    heapify(heap)
    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap)[1])
        if len(popped) >= least:
            yield top, len(popped)
            for i in popped:
                at[i] += 1
        else:
            popped += [heappop(heap)[1] for _ in range(least - 1 - len(popped))]
            for i in popped:
                at[i] = bisect_left(lists[i], heap[0][0], at[i])
        for i in popped:
            if at[i] < len(lists[i]):
                heappush(heap, (lists[i][at[i]], i))


def _candidates(percent: int):
    """a, b, n: from lists sorted by the set they belong to, sets that are in enough of its lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size, lists, out = None, 0, [], []

        def searched():
            smallest = int(required(size, percent))  # that may link to it
            least = min(TAU, int(required(smallest, percent)))
            out.extend((now, b, n) for b, n in merge_skip(lists, least))

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "n"])
            out.clear()
            return batch

        for batch in batches:
            for q, n, ids in zip(batch.column("q").to_pylist(), batch.column("n").to_pylist(), batch.column("ids").to_pylist()):
                if q != now:
                    if lists:
                        searched()
                    now, size, lists = q, n, []
                lists.append(ids)
            if out:
                yield rows()
        if lists:
            searched()
        if out:
            yield rows()
    return run


def _probed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(_arrays(batch.column("ea")), _arrays(batch.column("eb"))):
                few, many = (x, y) if len(x) < len(y) else (y, x)
                common = int(np.count_nonzero(_member(few, many)))
                linked.append((100 + percent) * common >= percent * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


def _counted(percent: int):
    """a, b: links between the two sides (0, 1) of each task's blocks, from rows sorted by `task`."""
    def links(sides: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
        if not sides[0] or not sides[1]:
            return
        (ids, roots, n), (other_ids, other_roots, other_n) = (
            (np.array([r[0] for r in side]), np.array([r[1] for r in side]), np.array([len(r[2]) for r in side])) for side in sides)
        x, y = (np.concatenate([r[2] for r in side]) for side in sides)
        of_x, of_y = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(other_n)), other_n)
        order = np.argsort(y, kind="stable")
        y, of_y = y[order], of_y[order]
        begins, ends = np.searchsorted(y, x), np.searchsorted(y, x, "right")
        met = ends > begins
        begins, ends, of_x = begins[met], ends[met], of_x[met]
        upto = np.cumsum(ends - begins)
        common = np.zeros(len(n) * len(other_n), np.int64)
        for part in np.split(np.arange(len(upto)), np.searchsorted(upto, np.arange(1 << 21, upto[-1] if len(upto) else 0, 1 << 21))):
            k = ends[part] - begins[part]
            at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(begins[part], k)
            common += np.bincount(np.repeat(of_x[part], k) * len(other_n) + of_y[at], minlength=len(common))
        common = common.reshape(len(n), len(other_n))
        linked = ((100 + percent) * common >= percent * (n[:, None] + other_n)) & (roots[:, None] != other_roots)
        i, j = np.nonzero(linked)
        yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(other_ids[j])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, [[], []]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("task", "side", "id", "root")]
            for task, side, id, root, elements in zip(*columns, batch.column("elements")):
                if task != now:
                    yield from links(sides)
                    now, sides = task, [[], []]
                sides[side].append((id, root, np.frombuffer(elements.as_py(), np.uint64)))
        yield from links(sides)
    return run


# ---- the join -------------------------------------------------------------------------

_ENTRIES = "x bigint, id bigint, n int, at int, late boolean"
_NONE = np.empty(0, np.uint64)


class _Join:
    def __init__(self, work: Workspace, docs: DataFrame, key: str, text: str, percent: int, width: int):
        self.work, self.percent, self.width = work, percent, width
        self.docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"))
        kind = self.docs.schema["key"].dataType.simpleString()
        sets = work.keep(self.docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            tidy(_heads(percent, width)), f"key {kind}, hash bigint, row bigint, n bigint, print binary, head binary"), "sets")
        self.rows, self.number = sets.select("key", "n", "print"), sets.count()
        self.classes = work.keep(dealt(sets.where("n > 0 AND key IS NOT NULL").groupBy("print").agg(
            F.min("row").alias("id"), F.min(F.struct("key", "hash")).alias("first"), F.any_value("n").alias("n"),
            F.any_value("head").alias("head")).select("print", "id", "first.*", "n", "head"), self.number), "classes")
        self.whole, self.links, self.turn, self.entered = None, None, 0, 0

    def need(self, ids: DataFrame) -> DataFrame:
        """Makes the whole sets of the classes `ids` (id), unless they are there; those that were not there."""
        self.turn += 1
        ids = ids.distinct()
        if self.whole is not None:
            ids = ids.join(self.whole.select("id"), "id", "left_anti")
        wanted = self.classes.join(ids, "id").select(F.col("key").alias("key_"), F.col("hash").alias("hash_"), "id")
        wanted = self.work.keep(dealt(wanted, self.number), f"wanted_{self.turn}")
        same = (F.col("key") == F.col("key_")) & (F.col("hash") == F.col("hash_"))
        count = wanted.count()
        if not count and self.whole is not None:
            return self.whole.where("false")
        # The other texts stay where they are, if the list is small enough for every executor.
        listed = F.broadcast(wanted) if count <= BROADCAST_ROWS else wanted
        whole = self.docs.join(listed, same).select("id", "text").mapInArrow(
            tidy(_whole(self.width)), "id bigint, n bigint, elements binary")
        whole = self.work.keep(whole, f"whole_{self.turn}")
        if whole.count() > count:  # repeated rows
            whole = self.work.keep(dealt(whole.dropDuplicates(["id"]), count, SETS), f"whole_{self.turn}_once")
        self.whole = whole if self.whole is None else self.whole.unionByName(whole)
        return whole

    def entries(self) -> DataFrame:
        """x, id, n, at, late: of every class its first shingles in the final order, and whether they are among the last."""
        heads = self.classes.select("id", "n", F.col("head").alias("elements"))
        sets, known = heads, _NONE
        found = heads.mapInArrow(tidy(_entries(self.percent, known)), _ENTRIES).select("x")
        for _ in range(ROUNDS):
            counted = found.groupBy("x").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > SHORT)
            most = counted.orderBy(F.col("c").desc(), "x").limit(FREQUENT - len(known)).select("x").toArrow()
            new = np.sort(np.asarray(most.column("x").combine_chunks()).view(np.uint64))
            if len(new):
                found = sets.mapInArrow(tidy(_entering(self.percent, known, new)), "x bigint")
                known = np.sort(np.concatenate([known, new]))
            elif sets is heads:  # on with those whose heads are used up
                sets = self.need(heads.mapInArrow(tidy(_untold(self.percent, known)), "id bigint"))
                found = sets.mapInArrow(tidy(_entries(self.percent, known)), _ENTRIES).where("NOT late").select("x")
            else:
                break
        self.need(heads.mapInArrow(tidy(_untold(self.percent, known)), "id bigint"))
        return self.work.keep(heads.unionByName(self.whole).mapInArrow(tidy(_entries(self.percent, known)), _ENTRIES), "entries")

    def probe(self, pairs: DataFrame, rows: int) -> int:
        """Adds the links among the pairs (a, b), at most some `rows`, that are not tied yet; how many there are."""
        self.turn += 1
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = self.work.keep(dealt(pairs, rows, NUMBERS), f"pairs_{self.turn}")
        sets = self.whole.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi").select("id", "elements")
        with_both = pairs.join(sets.toDF("a", "ea"), "a").join(sets.toDF("b", "eb"), "b")
        with_both = dealt(with_both.select("a", "b", "ea", "eb"), pairs.count(), SETS)
        found = self.work.keep(with_both.mapInArrow(tidy(_probed(self.percent)), "a bigint, b bigint"), f"links_{self.turn}")
        self.links = found if self.links is None else self.links.unionByName(found)
        return found.count()

    def roots(self) -> DataFrame:
        """id, root for sets that are tied to another. From here on the links are those to the root."""
        self.turn += 1
        roots = connected(self.work, self.links, f"tied_{self.turn}", self.links.count())
        roots = self.work.keep(dealt(roots, self.number, NUMBERS), f"roots_{self.turn}")
        self.links = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
        return roots.withColumnRenamed("node", "id")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sets are in different components so far."""
        roots = self.roots()
        for side in ("a", "b"):
            pairs = pairs.join(roots.select(F.col("id").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
        return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")

    def short_lists(self, entries: DataFrame) -> DataFrame:
        """Links of all lists but the long ones; which those are (x)."""
        long = entries.where("late").groupBy("x").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > LONG).select("x")
        rows = entries.count()
        long = self.work.keep(dealt(long, rows, ENTRIES), "long_late")
        short = entries.join(long, "x", "left_anti").select("x", "id", "n", "at")
        lists = self.work.keep(dealt(short.repartition("x"), rows, ENTRIES).sortWithinPartitions("x", "id").mapInArrow(
            tidy(_lists(self.percent, LONG)), "q bigint, n bigint, ids array<bigint>"), "lists")
        found = self.work.keep(dealt(lists.where("n IS NOT NULL").repartition("q"), lists.count(), NUMBERS).sortWithinPartitions("q").mapInArrow(
            tidy(_candidates(self.percent)), "a bigint, b bigint, n bigint"), "candidates")
        self.need(found.select(F.explode(F.array("a", "b")).alias("id")))
        self.probe(found.groupBy("b").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("a")), self.number)
        self.probe(self.apart(found), found.count())
        long = self.work.keep(long.unionByName(lists.where("n IS NULL").select(F.col("q").alias("x"))), "long_all")
        self.work.forget("lists", "candidates")
        return long

    def long_lists(self, entries: DataFrame) -> None:
        """entries: x, id, n, at of the lists that are not merged."""
        entries = self.work.keep(dealt(entries, self.entered, ENTRIES), "long")
        self.work.forget("entries")
        if entries.isEmpty():
            return
        self.need(entries.select("id"))
        rows = entries.count()
        for turn in range(HUB_ROUNDS + 1):
            rooted = self.rooted(entries, rows)
            by_root = dealt(rooted.groupBy("x", "root").agg(F.count(F.lit(1)).alias("c")), rows, ENTRIES)
            lists = self.work.keep(dealt(by_root.groupBy("x").agg(
                F.sum("c").alias("size"), F.max("c").alias("most"), F.max_by("root", F.struct("c", "root")).alias("largest")
            ).where("most < size"), rows, ENTRIES), f"lists_{self.turn}")
            if lists.isEmpty():
                return
            if turn < HUB_ROUNDS:
                outside = rooted.join(lists, "x").where("root <> largest").select(
                    "x", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("at").alias("at_b"), F.col("root").alias("root_b"))
                one = F.min_by(F.struct("b", "nb", "at_b", "root_b"), F.xxhash64("b", F.lit(turn)))
                self.probe(self.close(rooted, outside.groupBy("x").agg(one.alias("hub")).select("x", "hub.*")), rows)
        self.blocks(rooted.join(lists.select("x"), "x"), rows)

    def blocks(self, entries: DataFrame, rows: int) -> None:
        """Links among the sets of lists that are in different components, counted block by block."""
        first = F.min("id").alias("b")
        edges = entries.join(entries.groupBy("x").agg(first), "x").select(F.col("id").alias("a"), "b")
        groups = connected(self.work, edges, "grouped", rows)
        groups = self.work.keep(dealt(groups, self.number, NUMBERS), "groups").toDF("id", "group")
        # Sets that link are of one size level or of neighbouring ones.
        level = F.floor(F.log(F.col("n").cast("double")) / F.lit(np.log(100 / self.percent)) + F.lit(1e-9)).cast("int")
        sets = dealt(entries.select("id", "root", "n"), rows, ENTRIES).distinct().join(groups, "id").withColumn("level", level)
        sets = self.work.keep(dealt(sets, self.number, NUMBERS), "grouped_sets")
        largest = sets.groupBy("group", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("group").agg(F.max_by("root", F.struct("c", "root")).alias("largest"))
        sizes = sets.groupBy("group", "level").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
        sets = sets.join(largest, "group").join(sizes, ["group", "level"]).select(
            "group", "level", "id", "root", (F.col("root") != F.col("largest")).alias("outside"), F.pmod(F.hash("id"), F.col("blocks")).alias("block"))
        sets = self.work.keep(dealt(sets, self.number, NUMBERS), "blocked_sets")
        places = sets.groupBy("group", "level", "block").agg(F.max("outside").alias("outside"))
        near = places.select("group", F.explode(F.array(*[F.col("level") + i for i in (-1, 0, 1)])).alias("level"),
                             F.col("level").alias("level_b"), F.col("block").alias("block_b"))
        met = places.where("outside").join(near, ["group", "level"])
        met = dealt(met, self.number, NUMBERS).withColumn("task", F.monotonically_increasing_id()).drop("outside")
        met = self.work.keep(met, "block_pairs")
        asks = sets.where("outside").join(met, ["group", "level", "block"]).select("task", F.lit(0).alias("side"), "id", "root")
        all_sets = sets.join(met.select("group", F.col("level_b").alias("level"), F.col("block_b").alias("block"), "task"),
                             ["group", "level", "block"]).select("task", F.lit(1).alias("side"), "id", "root")
        rows = asks.unionByName(all_sets).join(self.whole.select("id", "elements"), "id")
        found = dealt(rows.select("task", "side", "id", "root", "elements").repartition("task"), met.count(), PAIRS).sortWithinPartitions("task").mapInArrow(
            tidy(_counted(self.percent)), "a bigint, b bigint")
        self.links = self.links.unionByName(self.work.keep(found, "links_blocks"))

    def rooted(self, entries: DataFrame, rows: int) -> DataFrame:
        rooted = entries.join(self.roots(), "id", "left").withColumn("root", F.coalesce("root", "id"))
        return self.work.keep(dealt(rooted, rows, ENTRIES), f"rooted_{self.turn}")

    def close(self, rooted: DataFrame, others: DataFrame) -> DataFrame:
        """Pairs of a list that are in different components and may link by size and place. A list's entries are dealt out
        by salt, and what they meet is there for every salt."""
        salted = rooted.withColumn("salt", F.pmod(F.hash("id"), F.lit(SALT)))
        others = others.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALT)))))
        size = F.col("n") + F.col("nb")
        most = F.least("at", "at_b") + F.least(F.col("n") - F.col("at"), F.col("nb") - F.col("at_b"))
        fits = ((100 + self.percent) * most >= self.percent * size) & (
            100 * F.least("n", "nb") >= self.percent * F.greatest("n", "nb"))
        met = salted.join(others, ["x", "salt"]).where((F.col("root") != F.col("root_b")) & fits)
        return met.select(F.col("id").alias("a"), "b")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, width: int = 4) -> DataFrame:
    """One row per row of `docs`: the key, n_shingles, component_id (the smallest key that links reach)."""
    spark = docs.sparkSession
    importable(spark)
    with Workspace(spark) as work:
        join = _Join(work, docs, key, text, percent, width)
        entries = join.entries()
        join.entered = entries.count()
        join.long_lists(entries.join(join.short_lists(entries), "x"))
        named = dealt(_named(join), join.number, NUMBERS)
        return result(spark, named.select(
            F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id")))


def _named(join: _Join) -> DataFrame:
    """The rows with their component's smallest key. A component's classes are dealt out by salt when they get it."""
    rooted = join.classes.join(join.roots(), "id", "left")
    tied = rooted.where("root IS NOT NULL").withColumn("salt", F.pmod(F.hash("id"), F.lit(SALT)))
    first = tied.groupBy("root").agg(F.min("key").alias("component")).withColumn("salt", F.explode(F.array(*map(F.lit, range(SALT)))))
    named = tied.join(first, ["root", "salt"]).select("print", "component").unionByName(
        rooted.where("root IS NULL").select("print", F.col("key").alias("component")))
    named = join.work.keep(dealt(named, join.number, NUMBERS), "named")
    return join.rows.join(named, "print", "left").select(
        "key", "n", F.when(F.col("key").isNotNull() & (F.col("n") > 0), F.col("component")).alias("component"))
