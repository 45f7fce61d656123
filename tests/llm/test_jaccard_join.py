"""Components against a brute-force version, and the merge against counting."""

import random
from collections import Counter

import pytest
from test_near_dedup import brute_set, near_copies

from threadloom.llm import jaccard_join
from threadloom.llm.jaccard_join import components, merge_skip
from threadloom.llm.work import Workspace


def brute(rows, percent=85, width=4):
    sets = [brute_set(t, width) for _, t in rows]
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
        if rows[i][0] is not None:
            for j in {j for x in s for j in inverted[x] if j > i and rows[j][0] is not None}:
                both = len(s & sets[j])
                if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                    root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), key), key) if key is not None else None
    return Counter((key, len(sets[i]), least[top(i)]) for i, (key, _) in enumerate(rows))


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, b"z") for r in rows], "doc_id bigint, text string, n string, row int, elements binary")
    found = components(df.repartition(5), **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, found.collect())) == brute(rows, options.get("percent", 85), options.get("width", 4))


def corpus():
    rng = random.Random(5)
    texts = ["", None, "  \t", "one", "One", "one two", "two one", "one two three", "a b c d", "A B\x0bC\x0cD", "a b c d e", "é É ß", "x " * 300]
    line = " ".join(f"boiler{i}" for i in range(30))
    for group in range(12):
        texts += near_copies(rng.randrange(1, 9), group, rng.choice([8, 20, 60, 150]))
    texts += [" ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) + " " + line for _ in range(70)]
    texts += [texts[20]] * 30 + ["only one copy " * 5] * 40
    texts.append(" ".join(f"v{rng.randrange(10**6)}" for _ in range(60_000)))
    texts.append(texts[-1] + " tail")
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_against_definition(spark):
    rows = corpus()
    check(spark, rows + rows[:20] + [(None, "a b c d"), (None, None), (7, "other text for id seven"), (7, "a b c d")])


def test_other_thresholds(spark):
    rows = corpus()[:120]
    check(spark, rows, percent=60, width=2)


@pytest.mark.parametrize("rounds", [0, 1])
def test_long_lists(spark, monkeypatch, rounds):
    """Groups of near copies far beyond the limits, at all distances around the threshold; also without single sets first."""
    for name, value in (("SHORT", 4), ("LONG", 10), ("BLOCK", 7), ("HUB_ROUNDS", rounds), ("FREQUENT", 300)):
        monkeypatch.setattr(jaccard_join, name, value)
    texts = near_copies(60, 1, 60) + near_copies(50, 2, 150) + near_copies(30, 3, 9)
    line = " ".join(f"boiler{i}" for i in range(30))
    rng = random.Random(2)
    texts += [" ".join(f"q{rng.randrange(10**6)}" for _ in range(50)) + " " + line for _ in range(40)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_empty_table(spark):
    check(spark, [])
    check(spark, [(1, None)])


def test_merge_skip():
    rng = random.Random(1)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randrange(1, 20))) for _ in range(rng.randrange(1, 12))]
        for least in (1, 2, 3, 5):
            counts = Counter(x for ids in lists for x in ids)
            assert dict(merge_skip(lists, least)) == {x: n for x, n in counts.items() if n >= least}


def test_few_rows_are_few_tasks(spark, monkeypatch):
    """Whatever the session deals a shuffle into: small tables are not written in as many files."""
    words = [f"w{i}" for i in range(80)]
    texts = [" ".join(words[:60 + i % 20]) + (f" z{i // 2}" if i % 3 else "") for i in range(60)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").coalesce(2)
    files, keep = {}, Workspace.keep

    def counting(self, df, name):
        kept = keep(self, df, name)
        files[name] = len(kept.inputFiles())
        return kept

    monkeypatch.setattr(Workspace, "keep", counting)
    options = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        jaccard_join.components(docs).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files and max(files.values()) <= 24, files
