import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import toxicity
from threadloom.llm.shingles import mix, word_hashes
from threadloom.llm.work import importable, Workspace


def words_of(text):
    return [w.lower() for w in re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def name(word):
    if word is None:
        return 0
    data = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(data, np.array([len(data)]))[0][0])


def followed(texts):
    return [pair for t in texts for pair in zip([None, *words_of(t)], words_of(t))]


def neighbours(texts):
    """How many words before each word the sketch says, bit by bit."""
    bits = defaultdict(set)
    for before, word in followed(texts):
        h = int(mix(np.array([(name(before) + 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
        high = h >> 32
        bits[word].add((h % 8, next((i for i in range(32) if high >> i & 1), 31)))
    table = toxicity.neighbours_by_bits()
    return {w: table[len(b)] for w, b in bits.items()}


def brute(texts, shared):
    """P(word | before) of one class, by dictionaries."""
    pairs = Counter(followed(texts))
    kinds, total = Counter(w for _, w in pairs), Counter()
    for (v, _), n in pairs.items():
        total[v] += n
    own = {w: (k - toxicity.WORD_DISCOUNT) / len(pairs) for w, k in kinds.items() if k >= toxicity.WORD_MIN}
    rest = 1 - sum(own.values())
    kept = {vw: (n - toxicity.WORD_DISCOUNT) / total[vw[0]] for vw, n in pairs.items() if n >= toxicity.PAIR_MIN}
    left = defaultdict(lambda: 1.0)
    for (v, _), p in kept.items():
        left[v] -= p
    every = sum(shared.values())
    return lambda v, w: kept.get((v, w), 0) + left[v] * (own.get(w, 0) + rest * shared.get(w, 0) / every)


def labelled(n=240):
    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(n):
        words = list(rng.choice(plain, 30, p=np.arange(60, 0, -1) / 1830))
        if i % 3 == 0:
            for at in rng.integers(0, 29, 4):
                words[at:at + 2] = ["w3", "w7"] if i % 2 else ["Grumz,", "w5"]
        docs.append((i, " ".join(words) + ("." if i % 2 else "\n"), int(i % 3 == 0)))
    return docs


@pytest.fixture
def fitted(spark):
    docs = labelled()
    importable(spark)
    d = spark.createDataFrame([*docs, (900, "w1 never, labelled", None), (901, None, None)], "key int, text string, toxic int")
    with Workspace(spark) as work:
        seen = d.where("toxic IS NOT NULL")
        model, pairs = toxicity._word_model(work, seen, d.selectExpr("key", "coalesce(text, '') AS text"))
    texts = [t for _, t, _ in docs]
    shared = neighbours([*texts, "w1 never, labelled"])
    classes = [brute([t for _, t, y in docs if y == c], shared) for c in (1, 0)]
    return model, pairs, texts, shared, classes


def test_ratios_of_words_are_those_of_brute_force(fitted):
    model, _, texts, _, (toxic, ordinary) = fitted
    flat = toxicity.Ratios(np.empty(0, np.uint64), np.empty(0), np.empty(0, np.uint64), np.empty(0))
    got = toxicity.per_word(model, flat, pa.array([*texts, None, "", "w3 new w7 w3 w7"]))[:, 0]
    for text, value in zip([*texts, None, "", "w3 new w7 w3 w7"], got):
        words = followed([text])
        want = [math.log(1 - toxicity.MIX + toxicity.MIX * toxic(v, w) / ordinary(v, w)) if ordinary(v, w) else None
                for v, w in words]
        if None not in want:
            assert abs(value - (sum(want) / len(want) if want else 0)) < 1e-9
    assert len(model.pairs) and (model.pair_values > 1).any()


def test_word_models_are_distributions(fitted):
    *_, shared, classes = fitted
    for p in classes:
        for v in [None, "w0", "w3", "grumz", "nowhere"]:
            assert abs(sum(p(v, w) for w in shared) - 1) < 1e-9


def test_pairs_of_bytes_do_not_cross_words_or_texts(fitted):
    _, pairs, texts, _, _ = fitted
    want = np.zeros((256, 256))
    for text in [*texts, "w1 never, labelled"]:
        for word in words_of(text):
            padded = b" " + word.encode() + b" "
            for a, b in zip(padded, padded[1:]):
                want[a, b] += 1
    assert np.array_equal(pairs, want)


def test_sketch_counts_different_neighbours():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40, 1000, 50_000):
        got = []
        for _ in range(20):
            before = rng.integers(1, 1 << 63, n).astype(np.uint64)
            words, bits = toxicity._sketch(np.ones(2 * n, np.uint64), np.concatenate([before, before]))
            assert len(words) == 1
            got.append(toxicity.neighbours_by_bits()[int(np.bitwise_count(bits).sum())])
        assert abs(np.mean(got) / n - 1) < 0.2


def test_two_ordinary_words_that_are_an_insult_together(spark):
    rng = np.random.default_rng(8)
    plain = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(1200):
        words = list(rng.choice(plain, 40))
        for at in (5, 15, 25):  # each text has both words as often
            words[at:at + 3] = ["get", "lost", "now"] if i % 4 == 0 else ["lost", "now", "get"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = toxicity.fit(d, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = model.scores(pa.array([t for _, t in docs]))
    held = [(got[i] >= 0.3) == bool(y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 200 and np.mean(held) > 0.98


def test_scores_do_not_depend_on_how_rows_are_dealt(spark):
    docs, labels = corpus(400)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    l = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = []
    for n in (3, 7):
        dealt = d.repartition(n, "text")
        got.append(sorted((r.doc_id, r.score) for r in toxicity.score(dealt, toxicity.fit(dealt, l.repartition(n))).collect()))
    assert got[0] == got[1]


def test_sample_is_bounded_in_bytes_and_whole(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 2000)
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "key bigint, text string")
    known = spark.createDataFrame(labels, "key bigint, toxic int").selectExpr("*", "xxhash64(key) AS hash")
    with Workspace(spark) as work:
        rows = toxicity._chosen(work, d, known, 100).collect()
    for y in (0, 1):
        sizes = [len(r.text.encode()) for r in sorted(rows, key=lambda r: r.hash) if r.toxic == y]
        assert sum(sizes[:-1]) < 2000 <= sum(sizes)
    assert {(r.key, r.text) for r in rows} <= set(docs)


def test_model_is_a_distribution():
    """After any context the probabilities of all bytes add up to one, in either model."""
    words = ["scum", "scums", "clown", "clone", "calm"]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, stops, _ = toxicity._words(data, np.array([len(data)]))
    grams, counts = toxicity._counted(toxicity._grams(data, starts, stops)[0])
    pairs = np.zeros((256, 256))
    for a, b in zip(data[:-1], data[1:]):
        pairs[a, b] += 1
    keys, numbers, contexts, total, kinds = toxicity._class_model(grams, counts)
    low = toxicity.shared_model(pairs)
    assert np.allclose(low.sum(axis=1), 1)
    weight = toxicity.DISCOUNT * kinds / total
    p = np.zeros(len(keys))
    for length in range(3, toxicity.ORDER + 1):
        here = np.flatnonzero(toxicity._length(keys) == length)
        at = toxicity._find(contexts, toxicity.context(keys[here]))
        p[here] = (numbers[here] - toxicity.DISCOUNT) / total[at] + weight[at] * toxicity._lower(
            keys, p, contexts, weight, low, toxicity.shorter(keys[here]))
    for c in contexts:
        content, length = int(toxicity._content(np.array([c]))[0]), int(toxicity._length(np.array([c]))[0])
        every = toxicity._pack((np.uint64(content) << np.uint64(8)) | np.arange(256, dtype=np.uint64), np.full(256, length + 1))
        total_p = toxicity._lower(keys, p, contexts, weight, low, every).sum()
        assert abs(total_p - 1) < 1e-6


def corpus(n):
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("aeiou lmnrst"), 6)).replace(" ", "e") for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = list(rng.choice(plain, 60))
        for _ in range(3 if toxic else 0):
            words[rng.integers(60)] = "grumz" + "".join(rng.choice(list("abcdefgh"), 3))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_rows_with_endings_never_seen(spark):
    docs, labels = corpus(800)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = toxicity.fit(d, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    scores = {r.doc_id: r.score for r in toxicity.score(d, model).collect()}
    held = [(scores[i] >= 0.3, t) for i, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 100 and sum(p == bool(t) for p, t in held) / len(held) > 0.98


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = corpus(300)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    a, b = (toxicity.fit(d, spark.createDataFrame(x, "doc_id bigint, toxic int")) for x in (labels, turned))
    texts = pa.array([t for _, t in docs])
    assert np.array_equal(a.scores(texts), b.scores(texts))


def test_nulls_clashing_names_and_tables_without_labels(spark):
    docs, labels = corpus(200)
    rows = [*docs, (None, None), (7, "a"), (7, ""), (900, "long " * 100_000)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS score", "2 AS toxic", "3 AS hash")
    l = spark.createDataFrame([*labels, (None, 1), (5000, 1), (3, None)], "doc_id bigint, toxic int")
    out = toxicity.score(d, toxicity.fit(d, l)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.toxic == 2 for r in out)
    none = toxicity.fit(d, l.where("false"))
    assert {r.score for r in toxicity.score(d, none).collect()} == {0.0}
    assert toxicity.score(d.where("false"), none).count() == 0
    assert toxicity.fit(d.where("false"), l).ratios is None
