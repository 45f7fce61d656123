import random
import re

import pytest

from threadloom.llm import decontaminate
from threadloom.llm.work import Workspace

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(width, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(str(item))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for k in range(1, width + 1):
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i:i + k])]
        out.append((key, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows", [0, 1000])
def test_against_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "é", "don't"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, make(n)) for i, n in enumerate([25, 12, 10, 3, 2, 40])] + [(7, None), (8, "?!"), (9, make(11)), (9, make(30))]
    docs = [(i, make(rng.randrange(60))) for i in range(40)] + [(100, items[0][1]), (100, items[0][1]), (100, "other"),
            (None, "x " + items[5][1]), (None, None), (101, ""), (102, ",".join(words(items[1][1])).upper()), (103, "z " * 50_000)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("hash", decontaminate.F.lit(1))
    b = spark.createDataFrame(items, "item_id bigint, text string")
    with Workspace(spark) as work:
        got = decontaminate.find_hits(d, b, work).selectExpr(
            "key", "n_words", "size(covered)", "array_join(items, ',')").collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items)
    clean = decontaminate.drop_contaminated(d, b)
    assert clean.columns == d.columns
    assert clean.count() == sum(r[2] == 0 for r in brute(docs, items))


def test_cut_spans(spark):
    item = "one two three four five six seven eight nine ten"
    d = spark.createDataFrame([(1, f"Start, {item.upper()}! end."), (2, "clean text."), (3, None)], "doc_id int, text string")
    b = spark.createDataFrame([(1, item)], "item_id int, text string")
    got = {r.doc_id: r.text for r in decontaminate.cut_spans(d, b).collect()}
    assert got == {1: "Start! end.", 2: "clean text.", 3: None}


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    b = spark.createDataFrame([], "item_id int, text string")
    assert [r.contaminated for r in decontaminate.report(d, b).collect()] == [False]
    assert decontaminate.report(d.where("false"), b).count() == 0
