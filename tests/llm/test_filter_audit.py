import re
from collections import Counter
from itertools import permutations

from threadloom.llm.filter_audit import COUNTS, audit

SCHEMA = "doc_id bigint, text string, lang string, mask string, n int, part string"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """Row by row, order by order."""
    out, first = Counter(), {}
    for key, text, *_ in docs:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))

    def is_label(key, column):
        return key is not None and any(row[0] == key and row[column] == 1 for row in labels)

    for key, text, lang, *_ in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": key is not None and key > first[text]}
        for order in map("".join, permutations("ABCDE")):
            there = True
            for step, f in enumerate(order, 1):
                at = (lang or "", order, step)
                gone = there and fails[f]
                for name, hit in zip(COUNTS, (there and not fails[f], gone, fails[f] and not there,
                                              fails[f] and sum(fails.values()) == 1, gone and is_label(key, 1), gone and is_label(key, 2))):
                    out[*at, name] += hit
                out[lang or "", f, "shapley"] += gone
                there = there and not fails[f]
    return out


def docs():
    long = " ".join(f"word{i}" for i in range(220))
    texts = ["", None, "short", long, long + " #", long.upper(), "same " * 300, long, long, "A\x0bB  c\x85d", "é " * 199 + "É É",
             "same " * 300_000, long + "\n", "x | y"]
    made = [(i, texts[i % len(texts)], ["en", "de", None, ""][i % 5 % 4], "clash", i, "p") for i in range(90)]
    return made + [(None, long, "en", "", 0, ""), (None, long, "en", "", 0, ""), (3, long, "en", "", 0, ""), (200, long, "fr", "", 0, ""),
                   (200, long, "fr", "", 0, ""), (3, long, "de", "", 0, "")]


def test_against_rows(spark):
    labels = [(i, i % 3 == 0, i % 4 % 3) for i in range(0, 95, 2)] + [(4, 0, 1), (4, None, None), (None, 1, 1)]
    labels = [(a, None if b is None else int(b), c) for a, b, c in labels]
    found = audit(spark.createDataFrame(docs(), SCHEMA).repartition(4), spark.createDataFrame(labels, LABELS)).collect()
    wanted = brute(docs(), labels)
    assert len(found) == 4 * 600 and {r["part"] for r in found} == {"en", "de", "fr", ""}
    for r in found:
        assert [r[c] for c in COUNTS] == [wanted[r["part"], r["filter_order"], r["step"], c] for c in COUNTS]
        assert r["filter"] == r["filter_order"][r["step"] - 1] and r["shapley"] == wanted[r["part"], r["filter"], "shapley"]


def test_empty_tables(spark):
    none, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert audit(none, labels).count() == 0
    assert audit(spark.createDataFrame(docs()[:1], SCHEMA), labels).count() == 600
