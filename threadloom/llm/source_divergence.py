"""How far the words of a language's sources are apart, from an index built in one pass.

Terms are maximal `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+` with A-Z lower-cased. Each language keeps the V terms that occur in
at least `min_docs` of its documents. A group (language and source, or the language alone) gives each kept term with
`count` occurrences there `p = 1 + floor(10**9 * (count + 2) / (N + 2 * V))`, N being its occurrences of kept terms. Two groups
differ by `f = floor((p - q)**2 / (p + q))` in a term. All of it is whole numbers.

1. One pass over the texts counts terms in memory. When a block is full it is spilled as a run: for each shard (by the
   hash of language and term) pages of postings, sorted by term.
2. Each shard heap-merges the pages of its runs into frequencies. A page is opened when the merge reaches its first term,
   so a task holds one page of each run at most; beyond FAN_IN runs, runs are first merged into fewer ones.
3. Pairs of sources start from the value they would have without any common term: all V terms at count 0, plus what
   each side's own counts change, taken from how often each count occurs. The postings are then streamed once, and each
   term adds a correction to the pairs of sources that both have it. The result itself has one row per pair of sources.

Null texts, languages and sources are ''. A group without terms counts as one with N = 0, and where V is 0 values are 0.
The id is not read, so null and repeated ids and repeated rows are rows like any other. Texts of any length are counted in
pieces. An empty table gives no rows; columns of any other name are not read. The list of groups is joined by
broadcast where Spark finds it small. A term's postings (at most one for each source of the language) are one row.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace
from itertools import accumulate, chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.work import Workspace, importable, result, tidy

BLOCK_BYTES = 96 << 20  # of memory that a block may take, by estimate, before it is spilled as a run
ENTRY_BYTES = 220
PAGE, PAGES = 512, 64  # terms in a page, pages given out at once
FAN_IN = 2000  # runs merged at once
TILE, TILES = 512, 16  # sources to a side of a table of corrections, and tables held at once
PIECE = 1 << 20  # bytes of a text that are counted at once
SCALE = 10**9

_KEPT = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PAGES = ("shard int, lang string, run bigint, first binary, terms array<binary>, dfs array<bigint>, sizes array<bigint>, "
          "places array<bigint>, counts array<bigint>")
_NUMBERS = pa.list_(pa.int64())
_PAGE_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("lang", pa.string()), ("run", pa.int64()), ("first", pa.binary()), ("terms", pa.list_(pa.binary())),
    ("dfs", _NUMBERS), ("sizes", _NUMBERS), ("places", _NUMBERS), ("counts", _NUMBERS)])
_POSTINGS = "lang string, term string, df bigint, places array<int>, counts array<bigint>"
_POSTING_SCHEMA = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()),
                             ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])


# ---- blocks and runs ------------------------------------------------------------------

def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, some at a time; a piece ends between terms."""
    data = data.translate(_KEPT)
    if len(data) <= PIECE:
        yield data.split()
        return
    begin = 0
    while begin < len(data):
        end = begin + PIECE
        if end < len(data):
            end = data.find(b" ", end)
        end = len(data) if end < 0 else min(end, len(data))
        yield data[begin:end].split()
        begin = end


class _Block:
    """Postings in memory: occurrences by language, place of the source and term, and documents by language and term."""

    def __init__(self):
        self.counts: dict[str, dict[int, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.dfs: dict[str, Counter] = defaultdict(Counter)
        self.docs = 0

    def add(self, lang: str, place: int, text: bytes) -> None:
        counts, seen = self.counts[lang][place], None
        for terms in _pieces(text):
            counts.update(terms)
            seen = set(terms) if seen is None else seen.union(terms)
        self.dfs[lang].update(seen or ())
        self.docs += 1

    def size(self) -> int:
        entries = sum(len(c) for of in self.counts.values() for c in of.values()) + sum(map(len, self.dfs.values()))
        return ENTRY_BYTES * entries


def _spilled(block: _Block, run: int, shards: int) -> Iterator[pa.RecordBatch]:
    """The block as a run: pages of sorted postings, by language and shard."""
    for lang, dfs in block.dfs.items():
        terms = sorted(dfs)
        if not terms:
            continue
        shard = np.array([zlib.crc32(t) for t in terms], np.int64) % shards
        order = np.argsort(shard, kind="stable")  # by shard, then term
        shard = shard[order]
        to = dict(zip(terms, np.argsort(order).tolist()))  # places in that order
        by_place = [(place, c) for place, c in sorted(block.counts[lang].items()) if c]
        at = np.concatenate([np.fromiter(map(to.__getitem__, c), np.int64, len(c)) for _, c in by_place])
        counts = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for _, c in by_place])
        places = np.repeat([place for place, _ in by_place], [len(c) for _, c in by_place])
        by_term = np.argsort(at, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(terms)))])
        begins = np.searchsorted(shard, np.unique(shard))
        starts = np.concatenate([np.arange(a, b, PAGE) for a, b in zip(begins, [*begins[1:], len(terms)])])
        cuts = np.append(starts, len(terms))
        found = np.fromiter(map(dfs.__getitem__, terms), np.int64, len(terms))[order]
        terms = pa.array(terms, pa.binary()).take(pa.array(order))

        def lists(values, offsets: np.ndarray) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values) if isinstance(values, np.ndarray) else values)

        pages = pa.RecordBatch.from_arrays(
            [pa.array(shard[starts].astype(np.int32)), pa.array([lang] * len(starts)), pa.array([run] * len(starts)),
             terms.take(pa.array(starts)), lists(terms, cuts), lists(found, cuts), lists(np.diff(ends), cuts),
             lists(places[by_term], ends[cuts]), lists(counts[by_term], ends[cuts])], schema=_PAGE_SCHEMA)
        for i in range(0, len(starts), PAGES):
            yield pages.slice(i, PAGES)


def _indexed(shards: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, blocks = TaskContext.get().partitionId() << 32, _Block(), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for lang, place, text in zip(batch.column("lang").to_pylist(), batch.column("place").to_pylist(), texts):
                text = text.as_py()
                block.add(lang, place, text)
                if (block.docs % 64 == 0 or len(text) > PIECE) and block.size() > block_bytes:
                    yield from _spilled(block, task + blocks, shards)
                    block, blocks = _Block(), blocks + 1
        yield from _spilled(block, task + blocks, shards)
    return run


# ---- merging --------------------------------------------------------------------------

class _Page:
    """An open page: where the merge is in it, and what is there."""

    __slots__ = ("terms", "dfs", "ends", "places", "counts", "at")

    def __init__(self, batch: pa.RecordBatch, i: int):
        terms = batch.column("terms")[i].values
        ends = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1]
        data = terms.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes()
        ends = (ends - ends[0]).tolist()
        self.terms = [data[a:b] for a, b in zip(ends, ends[1:])]
        self.dfs, sizes, self.places, self.counts = (
            np.asarray(batch.column(c)[i].values).tolist() for c in ("dfs", "sizes", "places", "counts"))
        self.ends, self.at = [*accumulate(sizes, initial=0)], 0


def _summed(found: list[tuple[_Page, int]]) -> tuple[list[int], list[int]]:
    """Places and counts of a term on one or several pages, by place."""
    sums = Counter()
    for page, at in found:
        for i in range(page.ends[at], page.ends[at + 1]):
            sums[page.places[i]] += page.counts[i]
    places = sorted(sums)
    return places, [sums[p] for p in places]


def _heap_merged(batches: Iterator[pa.RecordBatch], by: list[str], min_docs: int = 0) -> Iterator[tuple]:
    """(values of `by`, term, df, places, counts) of terms in enough documents, from pages sorted by `by` and first term. Of
    each run the page that the merge has reached is open, and no other."""
    heap, now, number = [], None, 0

    def until(limit: bytes | None):
        while heap and (limit is None or heap[0][0] < limit):
            term, df, found = heap[0][0], 0, []
            while heap and heap[0][0] == term:
                _, place, page = heap[0]
                at = page.at
                df += page.dfs[at]
                found.append((page, at))
                page.at = at = at + 1
                if at < len(page.terms):
                    heapreplace(heap, (page.terms[at], place, page))
                else:
                    heappop(heap)
            if df >= min_docs:
                yield now, term, df, *_summed(found)

    for batch in batches:
        of = list(zip(*[batch.column(c).to_pylist() for c in by]))
        for i, first in enumerate(batch.column("first").to_pylist()):
            if of[i] != now:
                yield from until(None)
                now = of[i]
            else:
                yield from until(first)
            heappush(heap, (first, number, _Page(batch, i)))
            number += 1
    yield from until(None)


def _fewer_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of the run `into` from those of its runs."""
    for of, merged in groupby(_heap_merged(batches, ["shard", "into", "lang"]), key=itemgetter(0)):
        while page := list(islice(merged, PAGE)):
            _, terms, dfs, places, counts = zip(*page)
            yield pa.RecordBatch.from_pylist([{
                "shard": of[0], "lang": of[2], "run": of[1], "first": terms[0], "terms": terms, "dfs": dfs, "sizes": [*map(len, places)],
                "places": [*chain(*places)], "counts": [*chain(*counts)]}], _PAGE_SCHEMA)


def _frequencies(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = _heap_merged(batches, ["shard", "lang"], min_docs)
        while rows := list(islice(merged, 2000)):
            of, terms, *others = zip(*rows)
            columns = [[lang for _, lang in of], [t.decode() for t in terms], *others]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _POSTING_SCHEMA.types)], schema=_POSTING_SCHEMA)
    return run


def _postings(work: Workspace, docs: DataFrame, groups: DataFrame, min_docs: int) -> DataFrame:
    """Kept terms of each language with the occurrences in each source that has them, by its place in the language."""
    shards = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.join(groups, ["lang", "source"]).select("lang", "place", "text")
    runs = work.keep(placed.mapInArrow(tidy(_indexed(shards, BLOCK_BYTES)), _PAGES), "runs")
    count, turn = runs.select("run").distinct().count(), 0
    while count > FAN_IN:
        count = -(-count // FAN_IN)
        into = F.pmod(F.xxhash64("run"), F.lit(count))
        gathered = runs.withColumn("into", into).repartition("shard", "into").sortWithinPartitions("shard", "into", "lang", "first")
        turn += 1
        runs = work.keep(gathered.mapInArrow(tidy(_fewer_runs), _PAGES), f"runs_{turn}")
    merged = runs.repartitionById(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    return work.keep(merged.mapInArrow(tidy(_frequencies(min_docs)), _POSTINGS), "postings")


# ---- values ---------------------------------------------------------------------------

def probability(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / total); null where the total is 0."""
    scaled = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(total > 0, 1 + F.call_function("div", scaled, total.cast("decimal(20,0)")))


def divergence(p: Column, q: Column) -> Column:
    # Both are at most SCALE + 1, so the square is below 2 ** 63.
    return F.call_function("div", (p - q) * (p - q), p + q)


def _difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of what common terms change, by pairs of places, from one stream of terms. The sums of a tile of
    sources are one table; when there are too many, they are given out and begun anew."""
    tiles: dict[tuple[str, int, int], np.ndarray] = {}

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, i, j), table in tiles.items():
            a, b = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array((a + i * TILE).astype(np.int32)),
                 pa.array((b + j * TILE).astype(np.int32)), pa.array(table[a, b])], names=["lang", "place", "other", "value"])
        tiles.clear()

    def lists(column: pa.Array) -> list[np.ndarray]:
        values, ends = np.asarray(column.flatten()), np.cumsum(np.asarray(column.value_lengths().fill_null(0)))
        return np.split(values, ends[:-1])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang, place, p, p0 in zip(langs, *[lists(batch.column(c)) for c in ("places", "ps", "p0s")]):
            cuts = np.split(np.arange(len(place)), np.flatnonzero(np.diff(place // TILE)) + 1)
            for x in cuts:
                for y in cuts:
                    here = (lang, int(place[x[0]]) // TILE, int(place[y[0]]) // TILE)
                    if here not in tiles:
                        if len(tiles) == TILES:
                            yield from given()
                        tiles[here] = np.zeros((TILE, TILE), np.int64)
                    a, a0, b, b0 = p[x, None], p0[x, None], p[None, y], p0[None, y]
                    tiles[here][np.ix_(place[x] % TILE, place[y] % TILE)] += (
                        _difference(a, b) - _difference(a, b0) - _difference(a0, b) + _difference(a0, b0))
    yield from given()


def _pairs(work: Workspace, postings: DataFrame, entries: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """lang, place, other and value, both ways."""
    side = groups.select("lang", "place", "p0")
    other = side.toDF("lang", "other", "q0")
    apart = divergence(F.col("p0"), F.col("q0"))
    # All terms at count 0, then what the counts of one side alone change.
    alone = entries.groupBy("lang", "place", "p").agg(F.count(F.lit(1)).alias("n"))
    changed = alone.join(side, ["lang", "place"]).join(other, "lang").where("place <> other").groupBy("lang", "place", "other").agg(
        F.sum(F.col("n") * (divergence(F.col("p"), F.col("q0")) - apart)).alias("value"))
    base = side.join(other, "lang").where("place <> other").join(langs.select("lang", "v"), "lang").select(
        "lang", "place", "other", F.coalesce(F.col("v") * apart, F.lit(0)).alias("value"))
    lists = langs.join(groups.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "total", "p0"))),
                       lambda g: F.struct(g["total"].alias("total"), g["p0"].alias("p0"))).alias("of")), "lang")

    def of(x: Column) -> Column:
        return F.element_at("of", x + 1)

    stream = postings.where(F.size("places") > 1).join(lists, "lang").select(
        "lang", "places", F.zip_with("places", "counts", lambda x, c: probability(c, of(x)["total"])).alias("ps"),
        F.transform("places", lambda x: of(x)["p0"]).alias("p0s"))
    common = stream.mapInArrow(tidy(_corrections), "lang string, place int, other int, value bigint").where("place <> other")
    both_ways = changed.unionByName(changed.select("lang", F.col("other").alias("place"), F.col("place").alias("other"), "value"))
    return base.unionByName(both_ways).unionByName(common).groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10,
          top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: every other source of the language by its value; part `term`: the
    `top` terms that a source has more of than its language."""
    spark = docs.sparkSession
    importable(spark)

    def text_of(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(""))

    docs = docs.select(text_of(text).alias("text"), text_of(lang).alias("lang"), text_of(source).alias("source"))
    with Workspace(spark) as work:
        place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        named = work.keep(docs.select("lang", "source").distinct().withColumn("place", place), "named")
        postings = _postings(work, docs, named, min_docs)
        entries = postings.select("lang", "term", F.explode(F.arrays_zip("places", "counts")).alias("e")).select(
            "lang", "term", F.col("e.places").alias("place"), F.col("e.counts").alias("count"))
        kept = postings.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
        langs = named.select("lang").distinct().join(kept, "lang", "left").fillna(0, ["v"])
        sums = entries.groupBy("lang", "place").agg(F.sum("count").alias("n"))
        groups = named.join(sums, ["lang", "place"], "left").join(langs, "lang").withColumn(
            "total", F.coalesce("n", F.lit(0)) + 2 * F.col("v"))
        groups = work.keep(groups.withColumn("p0", probability(F.lit(0), F.col("total"))), "groups")
        whole = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.first("v").alias("v"))
        langs = work.keep(whole.select("lang", "v", (F.coalesce("n", F.lit(0)) + 2 * F.col("v")).alias("lang_total")), "langs")
        entries = work.keep(entries.join(groups.select("lang", "place", "total"), ["lang", "place"]).select(
            "lang", "term", "place", "count", probability(F.col("count"), F.col("total")).alias("p")), "entries")

        pairs = _pairs(work, postings, entries, groups, langs)
        names = named.select("lang", "place", "source")
        pairs = pairs.join(names, ["lang", "place"]).join(names.toDF("lang", "other", "item"), ["lang", "other"])
        in_lang = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b)
        overall = postings.join(langs, "lang").select("lang", "term", probability(in_lang, F.col("lang_total")).alias("q"))
        terms = entries.join(overall, ["lang", "term"]).where("p > q").join(names, ["lang", "place"]).withColumn(
            "value", divergence(F.col("p"), F.col("q"))).withColumnRenamed("term", "item")

        def ranked(rows: DataFrame, part: str) -> DataFrame:
            order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
            return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

        return result(spark, ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top)))
