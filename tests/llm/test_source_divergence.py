import re
from collections import Counter

import pyarrow as pa
import pytest

from threadloom.llm import source_divergence
from threadloom.llm.source_divergence import audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, term string, place int, value string"


def brute(rows, min_docs, top=10):
    """Every pair of sources and every term, by the definition."""
    docs = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for _, text, lang, source, *_ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= min_docs}
        counts = {s: Counter(t for d in docs if d[:2] == (lang, s) for t in d[2] if t in kept) for s in {d[1] for d in docs if d[0] == lang}}
        whole = sum(counts.values(), Counter())

        def p(of, t):
            return 1 + 10**9 * (of[t] + 2) // (sum(of.values()) + 2 * len(kept))

        def f(a, b, t):
            return (p(a, t) - p(b, t)) ** 2 // (p(a, t) + p(b, t))

        for s, own in counts.items():
            pairs = [(x, sum(f(own, of, t) for t in kept)) for x, of in counts.items() if x != s]
            terms = [(t, f(own, whole, t)) for t in own if own[t] and p(own, t) > p(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found) if part == "pair" or i < top}
    return out


def rows():
    words = ["alpha", "Beta", "gämma", "delta", "ÉCOLE", "zeta", "eta", "x", "日本", "theta"]
    made = [(i, " ".join(words[(i * k + k * k) % (3 + i % 8)] for k in range(i % 17)), ["en", "de", None][i % 3],
             [f"s{i % 7}", None, "s0"][i % 5 % 3], "clash", 1, "v") for i in range(160)]
    odd = [(None, None, "en", "only null", "", 0, ""), (1, "", "en", "s0", "", 0, ""), (1, "", "en", "s0", "", 0, ""),
           (2, "12 34 !?", "xx", "no terms", "", 0, ""), (3, "alpha " * 400_000 + "omega", "en", "long", "", 0, ""),
           (4, "a\x00b nul", "en\x00x", "s", "", 0, "")]
    return made + odd * 2


@pytest.mark.parametrize("small", [False, True])
def test_against_definition(spark, monkeypatch, small):
    """Also with blocks of a few documents, so that there are many runs, merged in several rounds."""
    if small:
        monkeypatch.setattr(source_divergence, "BLOCK_BYTES", 1)
        monkeypatch.setattr(source_divergence, "FAN_IN", 2)
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    for min_docs in (2, 10):
        found = audit(df, min_docs=min_docs).collect()
        assert {tuple(r) for r in found} == brute(rows(), min_docs) and len(found) == len(brute(rows(), min_docs))


def test_empty_table(spark):
    assert audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_sources_take_several_tiles(spark):
    n = source_divergence.TILE + 40
    made = [(i, "common word" + (" other" if i % 3 else "") + f" w{'abcdef'[i % 6]}", "en", f"s{i}", "", 0, "") for i in range(n)]
    found = audit(spark.createDataFrame(made, SCHEMA)).where("part = 'pair' AND source IN ('s0', 's551')").collect()
    assert len(found) == 2 * (n - 1)
    by = {(r["source"], r["item"]): r["value"] for r in found}
    assert by["s0", "s551"] == by["s551", "s0"] and by["s0", "s6"] == by["s0", "s12"] == 0 < by["s0", "s1"]


def test_heap_merge_opens_a_page_of_each_run(monkeypatch):
    a, b = source_divergence._Block(), source_divergence._Block()
    for i in range(20):
        a.add("en", i % 3, bytes([97 + i]) * 2 + b" x")
        b.add("en", 5, bytes([97 + i % 4]) * 2)
        b.add("de", 0, b"aa")
    rows = []
    for run, (block, size) in enumerate([(a, 4), (b, 2)]):
        monkeypatch.setattr(source_divergence, "PAGE", size)
        rows += [row for batch in source_divergence._spilled(block, run, 1) for row in batch.to_pylist()]
    rows.sort(key=lambda r: (r["lang"], r["first"]))
    opened, real = [], source_divergence._Page

    def counted(batch, i):
        opened.append(i)
        return real(batch, i)

    monkeypatch.setattr(source_divergence, "_Page", counted)
    merged, seen = {}, []
    for (_, lang), term, df, places, counts in source_divergence._heap_merged(
            iter([pa.RecordBatch.from_pylist(rows[:3], source_divergence._PAGE_SCHEMA),
                  pa.RecordBatch.from_pylist(rows[3:], source_divergence._PAGE_SCHEMA)]), ["shard", "lang"]):
        merged[lang, term] = df, dict(zip(places, counts))
        seen.append(len(opened))
    expected = {("en", bytes([97 + i]) * 2): (1 + 5 * (i < 4), {i % 3: 1} | ({5: 5} if i < 4 else {})) for i in range(20)}
    expected["en", b"x"] = (20, {0: 7, 1: 7, 2: 6})
    assert merged == expected | {("de", b"aa"): (20, {0: 20})}
    assert seen[0] < len(rows)  # pages further on were still closed


def test_probability_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(10**14, 3 * 10**14 + 7), (0, 5), (0, 0)], "c bigint, t bigint")
    assert [r[0] for r in df.select(source_divergence.probability(F.col("c"), F.col("t"))).collect()] == [
        1 + 10**9 * (10**14 + 2) // (3 * 10**14 + 7), 1 + 2 * 10**9 // 5, None]
