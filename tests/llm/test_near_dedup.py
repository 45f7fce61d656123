"""Components against a brute-force version, and the registers against known similarities."""

import functools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import near_dedup, set_sketch, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text, width=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent=85):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    inverted = {}
    for i, s in enumerate(sets):
        for x in s:
            inverted.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in inverted[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), key), key)
    return {(key, len(sets[i]), least[top(i)]) for i, (key, _) in enumerate(rows)}


def near_copies(n, seed, words=200):
    """A text and copies of it with 0 to 40 % of the words changed, too many for a small bucket."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy, share = list(base), rng.random() * 0.08
        for k in range(words):
            if rng.random() < share:
                copy[k] = f"e{rng.randrange(10 ** 9)}"
        out.append(" ".join(copy))
    return out


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_dedup.components(df, **more).collect()
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    return {(r.doc_id, r.n_shingles, r.component_id) for r in got}


def test_against_brute_force_with_a_large_group(spark):
    texts = near_copies(160, 1) + near_copies(5, 2, 30) + near_copies(60, 3, 80) + ["a b", "A  b", "a b c", "x", "", "\n"]
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_on_the_test_tables(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("small", [2, 5])
def test_the_exact_rest(spark, monkeypatch, small):
    """With nearly every bucket a large one the rest must find what the first members miss."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    rows = list(enumerate(near_copies(120, 9, 60)))
    assert found(spark, rows) == brute(rows)


def test_nulls_empty_texts_repeated_rows_and_long_texts(spark):
    long = " ".join(f"v{i}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (4, "A b\tc d"), (5, long), (6, long + " z")]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.components(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {(1, 1, True), (2, 2, True), (3, 3, True), (None, None, True), (4, 3, False), (5, 5, True), (6, 5, False)}


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "k"), (2, "a b c", 6, "l")], "doc_id bigint, text string, n int, key string")
    assert near_dedup.components(df.where("false")).count() == 0
    assert [tuple(r) for r in near_dedup.drop_near_duplicates(df).collect()] == [(1, "a b c", 5, "k")]
    assert near_dedup.drop_near_duplicates(df).columns == df.columns


def test_one_id_with_two_texts(spark):
    """A copy goes, another text with its id stays, and no group loses all its rows."""
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(3, b), (7, a), (7, b + " z"), (8, a + " y"), (9, "alone"), (9, "alone too"), (None, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in near_dedup.drop_near_duplicates(df).collect()), key=repr)
    assert got == sorted([(3, b), (7, a), (9, "alone"), (9, "alone too"), (None, a)], key=repr)
    same = spark.createDataFrame([(5, a), (5, a + " y"), (6, a + " x")], "doc_id bigint, text string")
    assert [r.doc_id for r in near_dedup.drop_near_duplicates(same).collect()] == [5]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (300, 900))
    r = set_sketch.registers(np.concatenate([a, b, a, b]), np.array([300, 1200, 2400, 2400]))
    assert (np.maximum(r[0], r[1]) == r[2]).all() and not r[3].any()
    near = np.concatenate([b[:850], a[:50]])
    r = set_sketch.registers(np.concatenate([b, near]), np.array([900, 1800]))
    j = set_sketch.estimate(r[:1], r[1:], np.array([900]), np.array([900]))[0]
    assert abs(j - 850 / 950) < 0.12


def test_word_hashes_do_not_depend_on_the_slice(monkeypatch):
    import pyarrow as pa
    texts = pa.array(["a bb  ccc", None, "bb\nA", "", "ccc bb a"])
    whole = [h.tolist() for _, d, e in shingles.text_slices(texts) for h in [shingles.word_hashes(d, e)[0]]]
    monkeypatch.setattr(shingles, "_SLICE", 4)
    parts = [h.tolist() for _, d, e in shingles.text_slices(texts) for h in [shingles.word_hashes(d, e)[0]]]
    assert sum(whole, []) == sum(parts, []) and len(parts) > len(whole)


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_pairs_of_a_shingle_are_those_that_sizes_and_places_allow(spark, percent):
    rng = random.Random(percent)
    rows = [(i, n, i % 3, rng.randint(n * percent // 100, n), i) for i in range(150) for n in [rng.choice([1, 2, 5, 37, 100, 101, 10 ** 6])]]
    some = spark.createDataFrame(rows, "id bigint, n bigint, x bigint, rest bigint, root bigint")
    got = near_dedup._facing(some, some, percent).collect()
    pairs = [(r.id, r.b) for r in got]
    assert len(pairs) == len(set(pairs))
    assert {(a, b) for a, n, x, rest, _ in rows for b, nb, xb, rest_b, _ in rows
            if x == xb and n <= nb and (100 + percent) * min(rest, rest_b) >= percent * (n + nb)} <= set(pairs)


def test_sets_that_meet_too_late_are_not_paired(spark):
    """Each has 100 shingles, and the one they share comes after 16 of its own: no two of them can be linked at 80 percent."""
    many = spark.range(400).selectExpr("id", "100L n", "7L x", "84L rest", "id root")
    assert near_dedup._facing(many, many, 80).count() == 0


def test_frequent_shingles_are_not_joined(spark):
    """300 sets with 100 shingles in common and one that each shares with its neighbour."""
    elements = spark.range(300).selectExpr("id", "explode(concat(sequence(0L, 99L), array(1000 + id div 2))) x")
    shared = elements.groupBy("x").agg(F.count("*").alias("df")).where("df > 1")
    rows = near_dedup._uncommon(elements, shared, shared.where("df > 48")).collect()
    assert sorted(tuple(r) for r in rows) == [(i, 2, 1000 + i // 2) for i in range(300)]


@pytest.mark.parametrize("frequent", [1, 7, 10 ** 4])
def test_the_exact_rest_with_any_number_of_frequent_shingles(spark, monkeypatch, frequent):
    """Groups at the limit of the links, one text with nothing of its own and one with nothing else."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "FREQUENT", frequent)
    texts = near_copies(90, 21, 60) + near_copies(40, 22, 100)
    rows = list(enumerate([*texts, " ".join(texts[0].split()[:55]), *(f"{t} end of it" for t in texts[:30])]))
    assert found(spark, rows) == brute(rows)
    monkeypatch.setitem(globals(), "brute_set", functools.partial(brute_set, width=5))
    assert found(spark, rows, percent=80, width=5) == brute(rows, 80)


def test_a_set_finds_its_frequent_shingles_in_their_order():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"id": [4, 5, 6, 7], "text": ["a b c d e", None, "x y z", "c d e"]})
    of = {}
    for part in near_dedup._elements(3)([batch]):
        for i, x in zip(part["id"].to_pylist(), part["x"].to_pylist()):
            of.setdefault(i, []).append(x)
    ordered = np.array([of[7][0], *(x for x in of[4] if x != of[7][0]), 5], np.int64)
    got = [r for part in near_dedup._frequent(3, ordered)([batch]) for r in part.to_pylist()]
    assert got == [{"id": 4, "many": 3, "frequent": ordered[:3].tolist()}, {"id": 5, "many": 0, "frequent": []},
                   {"id": 6, "many": 0, "frequent": []}, {"id": 7, "many": 1, "frequent": of[7]}]
    nothing = [r["many"] for part in near_dedup._frequent(3, ordered[:0])([batch]) for r in part.to_pylist()]
    assert nothing == [0, 0, 0, 0]
