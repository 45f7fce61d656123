import hashlib
import zlib
from collections import Counter

import pytest

from threadloom.llm import sharding


@pytest.mark.parametrize("rows", [
    [(i, f"t{i}") for i in range(1003)], [(1, "a")] * 500 + [(None, None)] * 300 + [(i, "b") for i in range(7)], [(1, "x")]])
def test_counts_and_slots(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS size", "2 AS row", "3 AS cell")
    out = sharding.shard_rows(df, 24).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in out) == sorted(
        (k or -1, len(t or "") + 8, zlib.crc32((t or "").encode())) for k, t in rows)
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(24)) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))


def test_empty_table(spark):
    assert sharding.shard_rows(spark.createDataFrame([], "doc_id bigint, text string"), 24).count() == 0


def test_few_rows_move_when_a_shard_is_added():
    bins = {(c, 0): 10 for c in range(sharding.CELLS)}
    where = [{}, {}]
    for found, shards in zip(where, (24, 25)):
        for cell, salt, first, last, shard, _ in sharding.place_bins(bins, shards):
            found.update({(cell, n): shard for n in range(first, last + 1)})
    moved = sum(where[0][k] != where[1][k] for k in where[0]) / len(where[0])
    assert moved < 0.35


def test_most_rows_are_at_home():
    bins = {(c, 0): 10 for c in range(sharding.CELLS)}
    homes = sharding.home_of_cells(24)
    at_home = sum(last - first + 1 for cell, _, first, last, shard, _ in sharding.place_bins(bins, 24) if homes[cell] == shard)
    assert at_home / (10 * sharding.CELLS) > 0.85


def test_shards_do_not_depend_on_files(spark):
    rows = [(i % 700, f"t{i % 900}") for i in range(4000)] + [(None, f"n{i}") for i in range(900)] + [(None, None)] * 40 + [(5, "t5")] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [Counter(map(tuple, sharding.shard_rows(df.repartition(n), 24).collect())) for n in (3, 7)]
    assert found[0] == found[1] and sum(found[0].values()) == len(rows)


def test_ring_against_walking_it():
    """Each cell's home is that of the next virtual node, and each bin's rows go to the first shards clockwise with room."""
    cells, shards = 64, 5
    nodes = {}
    for shard in range(shards):
        for node in range(sharding.VIRTUAL_NODES):
            place = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8]) % cells
            nodes[place] = min(nodes.get(place, shard), shard)

    def next_shard(cell):
        return next(nodes[(cell + i) % cells] for i in range(cells) if (cell + i) % cells in nodes)

    assert sharding.home_of_cells(shards, cells) == [next_shard(c) for c in range(cells)]
    counts = {(c, s): (c * 7 + s * 3) % 11 for c in range(cells) for s in range(2)}
    room = sharding.bounds(sum(counts.values()), shards)
    wanted, left = Counter(), []
    for (cell, salt), n in sorted(counts.items()):
        for i in range(n):
            home = next_shard(cell)
            if room[home]:
                room[home] -= 1
                wanted[cell, salt, home] += 1
            else:
                left.append((cell, salt))
    for cell, salt in left:
        at = next(x for x in ((cell + i) % cells for i in range(1, cells + 1)) if room[next_shard(x)])
        room[next_shard(at)] -= 1
        wanted[cell, salt, next_shard(at)] += 1
    found = Counter()
    for cell, salt, first, last, shard, _ in sharding.place_bins(counts, shards, cells):
        found[cell, salt, shard] += last - first + 1
    assert found == wanted
