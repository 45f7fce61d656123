import hashlib
import random
from collections import Counter

import pytest

from threadloom.llm import suffix_dedup
from threadloom.llm.bwt_repeats import repeated_starts
from threadloom.llm.work import Workspace


def brute_starts(parts, least):
    seen = Counter(p[i:i + least] for p in parts for i in range(len(p) - least + 1))
    return [[i for i in range(len(p) - least + 1) if seen[p[i:i + least]] > 1] for p in parts]


def brute(rows, least):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (key, _), text, starts in zip(rows, texts, brute_starts(texts, least)):
        gone = bytearray(len(text))
        for i in starts:
            gone[i:i + least] = b"\1" * least
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(text), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(text, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_starts():
    rng = random.Random(1)
    for _ in range(300):
        least = rng.choice([8, 9, 10, 20, 33, 60])
        alphabet = rng.choice([b"a", b"ab", b"abcd", bytes(range(256))])
        base = bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 300)))
        parts = []
        for _ in range(rng.randrange(1, 12)):
            i = rng.randrange(len(base))
            part = bytearray(base[i:rng.randrange(i, len(base) + 1)] + bytes(rng.choice(alphabet) for _ in range(rng.randrange(30))))
            if part and rng.random() < 0.5:
                part[rng.randrange(len(part))] = rng.choice(alphabet)
            parts.append(bytes(part))
        assert [g.tolist() for g in repeated_starts(parts, least)] == brute_starts(parts, least)


@pytest.mark.parametrize("least, piece, together", [(20, 8, 1 << 20), (20, 8, 50), (40, 20, 300)])
def test_against_brute_force(spark, monkeypatch, least, piece, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    monkeypatch.setattr(suffix_dedup, "LONGEST_RUN", 30)
    rng = random.Random(least)
    make = lambda n: "".join(rng.choice("abcdé 漢") for _ in range(n))
    passage, other = make(100), make(60)
    rows = [(i, make(rng.randrange(40)) + rng.choice([passage, passage[:50], other, ""]) + make(rng.randrange(40)))
            for i in range(60)] + [(70, passage * 3), (71, "a" * 300), (72, "ab" * 100), (73, None), (74, ""), (None, passage),
                                   (None, "q" + other), (75, make(2000)), (76, "same " * 9), (76, "same " * 9), (76, make(90))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("sha", suffix_dedup.F.lit("x"))
    got = suffix_dedup.report(df, least=least, piece=piece).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, least)
    left = suffix_dedup.remove_repeats(df, least=least, piece=piece)
    assert left.columns == df.columns and left.count() == len(rows)


@pytest.mark.parametrize("crowded", [300, 0])
def test_a_passage_in_many_surroundings_meets_in_no_single_transform(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 100)
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)

    def bounded(parts, least):
        assert sum(map(len, parts)) <= 100 + 300
        return repeated_starts(parts, least)

    monkeypatch.setattr(suffix_dedup, "repeated_starts", bounded)
    rng = random.Random(8)
    make = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = make(60)
    rows = [(i, make(30) + passage[rng.randrange(10):] + make(30)) for i in range(80)]
    rows += [(i + 100, t) for i, (_, t) in enumerate(rows[:3])] + [(200 + i, "x" + rows[9][1]) for i in range(2)] + [(300, make(50))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = suffix_dedup.report(df, least=40, piece=16).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 40)


def test_remove_repeats(spark):
    same = "".join(chr(97 + i * i % 26) for i in range(30)) + "".join(map(str, range(40)))
    df = spark.createDataFrame([(1, "é" + same + "end"), (2, "x" + same), (3, "short"), (4, None)], "doc_id int, text string")
    got = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(df, least=40, piece=16).collect()}
    assert got == {1: "éend", 2: "x", 3: "short", 4: None}


def test_empty_table(spark):
    assert suffix_dedup.report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark, sf):
    from threadloom.llm.queries import op8_suffix_dedup
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op8_suffix_dedup(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    with Workspace(spark):
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 400)
