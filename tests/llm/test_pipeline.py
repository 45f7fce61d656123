"""The pipeline stage by stage against brute force, on the smallest tables."""

import base64

import tiktoken

import corpus_pipeline as cp
from test_decontaminate import brute as brute_hits
from test_near_dedup import brute as brute_components
from threadloom.llm import toxicity


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels)).collect()
    kept = {r.doc_id for r in scores if r.score < cp.TOXIC}
    groups = {}
    for i in sorted(kept):
        groups.setdefault(rows[i].translate(dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))), []).append(i)
    kept = sorted(min(g, key=lambda i: (-len(rows[i]), i)) for g in groups.values())
    kept = sorted(i for i, _, root in brute_near([(i, rows[i]) for i in kept]) if i == root)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = sorted(i for i, _, hit, _ in brute_hits([(i, rows[i]) for i in kept], items) if not hit)
    with open(cp.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=cp.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r.tokens for r in cp.run(spark, sf).collect()}
    assert got == {i: enc.encode_ordinary(rows[i]) for i in kept}
    assert 0 < len(got) < len(rows)


def brute_near(rows):
    import test_near_dedup
    old = test_near_dedup.brute_set
    test_near_dedup.brute_set = lambda text: old(text, cp.NEAR_WORDS)
    try:
        return brute_components(rows, cp.NEAR_PERCENT)
    finally:
        test_near_dedup.brute_set = old


def test_columns_stay_until_the_last_stage_and_empty_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs.where("false"), sf)
        assert out.columns == docs.columns and out.count() == 0
    assert cp.STAGES[-1][1](spark, docs.where("false"), sf).count() == 0


def test_nulls(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    docs = spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (1, None, None, None, None),
                                  (2, "a b c d e f", None, None, None), (2, "a b c d e f", None, None, None)], schema)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() >= 1
