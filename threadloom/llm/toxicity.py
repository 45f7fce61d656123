"""Toxicity by Kneser-Ney models of word sequences and of spellings, one of toxic and one of ordinary texts each.

A word is a run of letters, digits and bytes beyond ASCII, A-Z in lower case. The models of sequences interpolate
    pairs    P(w | v) = [v w] - WORD_DISCOUNT over all that follows v in labelled texts of the class, rest to
    words    P(w) = (different v before w in the class) - WORD_DISCOUNT over all such, rest to
    shared   Q(w) = different words before w in all documents, over their sum for all words.
So an expression that the labelled texts of a class have rarely or never is judged by how it occurs in the whole
corpus, the same for both classes. The start of a text is the first word's v. Pairs seen less than PAIR_MIN times and
words after less than WORD_MIN others in a class give their counts to the rest.

The models of spellings tell words of few labelled texts by what their parts share with others. They predict every byte,
and the blank that ends the word, from up to `ORDER` - 1 bytes before it in the word; orders 2 and 1 are the same for both
classes, from counts over all documents.

Different words before a word are counted by a sketch of 256 bits (`KINDS` bitmaps of 32 bits, a neighbour sets bit i of one
with chance 2**-(i+1)), merged by OR within tasks and then by word; the pairs themselves are more than half as many as
the words of the corpus. The sketch, so every score, does not depend on how rows are dealt.

Few words of a toxic text are toxic, so its words are taken to come from the toxic model with chance MIX, else from the
ordinary one. A text is compared by its log-likelihood per word under that and under the ordinary model, by sequence and by
spelling; a logistic regression on labelled texts that the models have not seen makes a score from 0 to 1 of both. The class counts come from at most `SAMPLE` labelled rows and about `SAMPLE_BYTES`
of text of each class, the first by the hash of their ids, with their whole texts, so what is broadcast is bounded; the
shared counts cover all rows and are a table that grows with them.

Null and empty texts have ratios of 0 and the score that goes with it. Labels that are null or belong to no row are not
used; with labels of one class only, or none, every score is the share of toxic labels (0 without any). A null id has no
label, and a null `held_out`. Repeated rows have equal scores. An empty table gives an empty result; no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.shingles import mix, text_slices, word_hashes
from threadloom.llm.work import importable, tidy, Workspace

ORDER = 6
SAMPLE = 8000
SAMPLE_BYTES = 32 << 20
DISCOUNT = 0.75
WORD_DISCOUNT = 0.9
WORD_MIN, PAIR_MIN = 3, 5  # what is seen less often in a class gives its count to the next order
FLOOR = 1e-3  # added to ratios per word before their logarithm is taken for the regression
MIX = 0.03  # share of a toxic text's words that are said to come from the toxic model
KINDS = 8  # bitmaps of 32 bits
HELD = 1 << 18  # distinct words a task holds before it gives them out
CALIBRATION = 4  # one labelled row in so many is kept for the regression
_BLANK = 32
_PLAIN = np.full(256, _BLANK, np.uint8)  # A-Z lower, what is no part of a word blank
for _from, _to in ((48, 58), (97, 123), (128, 256)):
    _PLAIN[_from:_to] = np.arange(_from, _to)
_PLAIN[65:91] = np.arange(97, 123)
_U = np.uint64
_START = _U(0)  # stands before a text's first word


def held_out(key: Column) -> Column:
    """Rows whose labels are not learned from."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(4)) == 2


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of each word, and the number of words up to each row's end; plain bytes."""
    solid = data != _BLANK
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cut = ends[:-1][(ends[:-1] < len(data)) & (ends[:-1] > 0)]
    first[cut] = solid[cut]
    last[cut - 1] = solid[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, ends)


def _grams(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the words and the blank after each: the bytes up to it, ORDER at most and the blank
    before the word first, packed into a number with their count on top; and the number of the word."""
    sizes = stops - starts + 2  # blank, word, blank
    offsets = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(len(word)) - offsets[word]
    text = np.full(len(word), _BLANK, np.uint8)
    inner = (place > 0) & (place < sizes[word] - 1)
    text[inner] = data[(starts[word] + place - 1)[inner]]
    packed = np.zeros(len(word), _U)
    for back in range(ORDER):
        ok = place >= back
        shifted = text[:len(text) - back] if back else text
        value = np.zeros(len(word), _U)
        value[back:] = shifted
        packed |= np.where(ok, value << _U(8 * back), _U(0))
    length = np.minimum(place + 1, ORDER).astype(_U)
    packed |= length << _U(56)
    return packed[place > 0], word[place > 0]


def _length(gram: np.ndarray) -> np.ndarray:
    return (gram >> _U(56)).astype(np.int64)


def _pack(content: np.ndarray, length: np.ndarray) -> np.ndarray:
    return content | (length.astype(_U) << _U(56))


def _content(gram: np.ndarray) -> np.ndarray:
    return gram & _U((1 << 56) - 1)


def shorter(gram: np.ndarray) -> np.ndarray:
    """Without the first byte."""
    length = _length(gram) - 1
    return _pack(_content(gram) & ((_U(1) << (length * 8).astype(_U)) - _U(1)), length)


def context(gram: np.ndarray) -> np.ndarray:
    """Without the last byte."""
    return _pack(_content(gram) >> _U(8), _length(gram) - 1)


def _counted(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(values, return_counts=True)
    keys, at = np.unique(values, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys))


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted keys in sorted keys, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _get(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    at = _find(keys, wanted)
    return np.where(at >= 0, values[at] if len(values) else missing, missing)


def shared_model(pairs: np.ndarray) -> np.ndarray:
    """P(byte | byte before) from a 256 x 256 table of counts: the two lowest orders."""
    follow = (pairs > 0).sum(axis=0)
    one = (follow + 1 / 256) / (follow.sum() + 1)
    total, kinds = pairs.sum(axis=1, keepdims=True), (pairs > 0).sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        two = np.maximum(pairs - DISCOUNT, 0) / total + DISCOUNT * kinds / total * one
    return np.where(total > 0, two, one)


def _class_model(grams: np.ndarray, counts: np.ndarray):
    """Of one class: (gram, adjusted count) and (context, sum of counts, kinds of followers) for orders 3 up."""
    # A gram of the highest order or from a word's start has its count; of others, left neighbours count.
    grams, counts = _counted(grams, counts)
    keys, numbers = [], []
    level, n = np.empty(0, _U), np.empty(0)
    for length in range(ORDER, 2, -1):
        own = _length(grams) == length
        level, n = np.concatenate([level, grams[own]]), np.concatenate([n, counts[own]])
        keys.append(level)
        numbers.append(n)
        level, n = _counted(shorter(level))
    keys, numbers = _counted(np.concatenate(keys), np.concatenate(numbers))
    contexts, total = _counted(context(keys), numbers)
    _, kinds = _counted(context(keys))
    return keys, numbers, contexts, total, kinds


@dataclass
class Ratios:
    """log P(toxic) - log P(ordinary) of the grams that either model has, and of the weights that their contexts
    give to shorter grams."""
    grams: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray

    @classmethod
    def of(cls, toxic, ordinary, pairs: np.ndarray) -> Ratios:
        models = [_class_model(*toxic), _class_model(*ordinary)]
        grams = np.union1d(models[0][0], models[1][0])
        contexts = np.union1d(models[0][2], models[1][2])
        low = shared_model(pairs)
        logs, weights = [], []
        for keys, numbers, own, total, kinds in models:
            p = np.zeros(len(grams))
            sums, weight = _get(own, total, contexts, 0), np.ones(len(contexts))
            weight[sums > 0] = DISCOUNT * _get(own, kinds, contexts, 0)[sums > 0] / sums[sums > 0]
            for length in range(3, ORDER + 1):
                here = np.flatnonzero(_length(grams) == length)
                if not len(here):
                    continue
                g = grams[here]
                at = _find(contexts, context(g))
                lower = _lower(grams, p, contexts, weight, low, shorter(g))
                own_count = np.maximum(_get(keys, numbers, g, 0) - DISCOUNT, 0)
                seen = sums[at] > 0
                p[here] = np.where(seen, own_count / np.maximum(sums[at], 1e-9), 0) + weight[at] * lower
            logs.append(np.log(p))
            weights.append(np.log(weight))
        return cls(grams, (logs[0] - logs[1]).astype(np.float32), contexts, (weights[0] - weights[1]).astype(np.float32))

    def of_grams(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams))
        todo = np.flatnonzero(_length(grams) >= 3)
        g = grams[todo]
        while len(todo):
            at = _find(self.grams, g)
            out[todo] += np.where(at >= 0, self.values[at], 0) if len(self.values) else 0
            todo, g = todo[at < 0], g[at < 0]
            out[todo] += _get(self.contexts, self.backoff, context(g), 0)
            g = shorter(g)
            long = _length(g) >= 3
            todo, g = todo[long], g[long]
        return out


def _lower(grams, p, contexts, weight, low, wanted) -> np.ndarray:
    """Probabilities of shorter grams, backing off where the model has none."""
    out, todo, g = np.ones(len(wanted)), np.arange(len(wanted)), wanted
    while len(todo):
        end = _length(g) < 3
        c = _content(g[end])
        out[todo[end]] *= low[(c >> _U(8)).astype(int), (c & _U(255)).astype(int)]
        todo, g = todo[~end], g[~end]
        at = _find(grams, g)
        out[todo[at >= 0]] *= p[at[at >= 0]]
        todo, g = todo[at < 0], g[at < 0]
        out[todo] *= _get(contexts, weight, context(g), 1)
        g = shorter(g)
    return out


def _pairs(hashes: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """The word before each word of its row."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[np.concatenate([[0], upto[:-1]])[np.diff(upto, prepend=0) > 0]] = _START
    return before


def _pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _U(0xD6E8FEB86659FD93) + word)


def _sketch(words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and the bits that those before them set, 4 numbers of 64 bits each."""
    h = mix(before + _U(0x9E3779B97F4A7C15))
    low = (h >> _U(32)).astype(np.uint32)
    rank = np.full(len(h), 31)
    some = low > 0
    rank[some] = np.log2((low[some] & -low[some]).astype(np.float64)).astype(np.int64)
    place = (h % _U(KINDS)).astype(np.int64) * 32 + rank
    order = np.argsort(words, kind="stable")
    words, place = words[order], place[order]
    bits = np.zeros((len(words), 4), _U)
    bits[np.arange(len(words)), place >> 6] = _U(1) << (place & 63).astype(_U)
    return _united(words, bits)


def _united(words: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of equal words, which stand together, by OR."""
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.empty(0, np.int64)
    return words[first], np.bitwise_or.reduceat(bits, first, axis=0) if len(words) else bits


def neighbours_by_bits() -> list[int]:
    """How many different neighbours set so many bits on average: 0 for 0, 1 for 1, and so on."""
    n = np.unique(np.round(2 ** np.arange(0, 40, 0.01)).astype(np.int64))
    chance = 2.0 ** -np.minimum(np.arange(1, 33), 31) / KINDS
    expected = np.array([KINDS * -np.expm1(x * np.log1p(-chance)).sum() for x in n])
    at = np.minimum(np.searchsorted(expected, np.arange(1, 32 * KINDS + 1) - 0.5), len(n) - 1)
    return [0, *n[at].tolist()]


@dataclass
class Words:
    """log P(toxic) - log P(ordinary) of the words and pairs that either class has; `backoff` of a word as the one
    before, `unknown` for a word that neither has."""
    words: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray
    pairs: np.ndarray
    pair_values: np.ndarray
    unknown: float

    @classmethod
    def of(cls, counts: list[dict], words: np.ndarray, shared: np.ndarray, total: int) -> Words:
        """`counts` of toxic and of ordinary texts: `word`, `kinds` (different words before it, WORD_MIN and more), `all_kinds`
        (over all words); `context`, `all` (what follows it), `kept`, `kept_kinds` (of that, pairs of PAIR_MIN and more);
        `before`, `after`, `n` of those pairs. `words` (sorted: those of either class, and `after`) have `shared`
        neighbours among all documents, all words have `total`."""
        contexts = np.unique(np.concatenate([c["context"] for c in counts]))
        names = [_pair_hash(c["before"], c["after"]) for c in counts]
        both, one = np.unique(np.concatenate(names), return_index=True)
        before, after = (np.concatenate([c[k] for c in counts])[one] for k in ("before", "after"))
        of_word, of_context, of_pair, of_rest = [], [], [], []
        for c, name in zip(counts, names):
            kinds = np.zeros(len(words))
            kinds[_find(words, c["word"])] = c["kinds"]
            own = np.maximum(kinds - WORD_DISCOUNT, 0) / c["all_kinds"]
            rest = 1 - own.sum()
            p = own + rest * shared / total
            follow, weight = np.ones(len(contexts)), np.ones(len(contexts))
            at = _find(contexts, c["context"])
            follow[at] = c["all"]
            weight[at] = 1 - (c["kept"] - WORD_DISCOUNT * c["kept_kinds"]) / c["all"]
            n = np.zeros(len(both))
            n[_find(both, name)] = c["n"]
            at = _find(contexts, before)
            of_pair.append(np.log(np.maximum(n - WORD_DISCOUNT, 0) / follow[at] + weight[at] * p[_find(words, after)]))
            of_word.append(np.log(p))
            of_context.append(np.log(weight))
            of_rest.append(np.log(rest))
        return cls(words, of_word[0] - of_word[1], contexts, of_context[0] - of_context[1], both,
                   of_pair[0] - of_pair[1], float(of_rest[0] - of_rest[1]))


def mixed(ratio: np.ndarray) -> np.ndarray:
    """Log-likelihood of MIX parts of the toxic and the rest of the ordinary model, over the latter's."""
    return np.log1p(MIX * np.expm1(np.minimum(ratio, 500)))


def per_word(known: Words, ratios: Ratios, texts: pa.Array) -> np.ndarray:
    """The mixed ratio per word of each text, by sequence and by spelling."""
    out = np.zeros((len(texts), 2))
    for row, data, ends in text_slices(texts):
        data = _PLAIN[data]
        hashes, upto = word_hashes(data, ends)
        if not len(hashes):
            continue
        different, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        starts, stops, _ = _words(data, ends)
        grams, word = _grams(data, starts[one], stops[one])
        spelt = mixed(np.bincount(word, ratios.of_grams(grams), len(one)))[back]
        value = _get(known.words, known.values, different, known.unknown)[back]
        before = _pairs(hashes, upto)
        at = _find(known.pairs, _pair_hash(before, hashes))
        seen = at >= 0
        value[seen] = known.pair_values[at[seen]]
        value[~seen] += _get(known.contexts, known.backoff, before[~seen], 0)
        number = np.diff(upto, prepend=0)
        some = np.flatnonzero(number)
        # Each text is added up by itself, so its ratio does not depend on those beside it.
        for i, x in enumerate((mixed(value), spelt)):
            out[row + some, i] = np.add.reduceat(x, (upto - number)[some]) / number[some]
    return out


def features(known: Words, ratios: Ratios, texts: pa.Array) -> np.ndarray:
    return np.log(np.maximum(per_word(known, ratios, texts), 0) + FLOOR)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each labelled text's grams, summed within a slice."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic"))
        for row, data, ends in text_slices(batch.column("text")):
            if not len(data):
                continue
            data = _PLAIN[data]
            starts, stops, upto = _words(data, ends)
            label = np.repeat(toxic[row:row + len(ends)], np.diff(upto, prepend=0))
            for value in (0, 1):
                grams, counts = _counted(_grams(data, starts[label == value], stops[label == value])[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), value, np.int32)), pa.array(grams.view(np.int64)),
                     pa.array(counts.astype(np.int64))], names=["toxic", "gram", "n"])


def _word_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each labelled text's words with the one before, counted within a slice."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic"))
        for row, data, ends in text_slices(batch.column("text")):
            hashes, upto = word_hashes(_PLAIN[data], ends)
            before = _pairs(hashes, upto)
            label = np.repeat(toxic[row:row + len(ends)], np.diff(upto, prepend=0))
            for value in (0, 1):
                own = label == value
                _, one, n = np.unique(_pair_hash(before[own], hashes[own]), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(one), value, np.int32)), pa.array(before[own][one].view(np.int64)),
                     pa.array(hashes[own][one].view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["toxic", "before", "after", "n"])


_SHARED = "spelt boolean, name bigint, n bigint, m0 bigint, m1 bigint, m2 bigint, m3 bigint"


def _shared_rows(spelt: bool, names: np.ndarray, n: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(names), spelt)), pa.array(names.view(np.int64)), pa.array(n.astype(np.int64)),
         *(pa.array(np.ascontiguousarray(bits[:, i]).view(np.int64)) for i in range(4))],
        names=["spelt", "name", "n", "m0", "m1", "m2", "m3"])


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all texts: words with the sketch of those before them, and counts of pairs of bytes in words and their blanks."""
    total = np.zeros(1 << 16, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def compact() -> tuple[np.ndarray, np.ndarray]:
        words, bits = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(words, kind="stable")
        return _united(words[order], bits[order])

    for batch in batches:
        for _, data, ends in text_slices(batch.column("text")):
            data = _PLAIN[data]
            hashes, upto = word_hashes(data, ends)
            if not len(hashes):
                continue
            held.append(_sketch(hashes, _pairs(hashes, upto)))
            if sum(len(w) for w, _ in held) > 2 * HELD:
                held[:] = [compact()]
                if len(held[0][0]) > HELD:
                    yield _shared_rows(False, held[0][0], np.zeros(len(held[0][0])), held[0][1])
                    held.clear()
            # Each byte of a word with the one before, and the blank after it, so none across words or texts.
            starts, stops, _ = _words(data, ends)
            inner = np.flatnonzero(data != _BLANK)
            first = np.zeros(len(data), bool)
            first[starts] = True
            own = data.astype(np.int32)
            left = np.where(first[inner], _BLANK, own[inner - 1])
            total += np.bincount((left << 8) + own[inner], minlength=1 << 16)
            total += np.bincount((own[stops - 1] << 8) + _BLANK, minlength=1 << 16)
    if held:
        words, bits = compact()
        yield _shared_rows(False, words, np.zeros(len(words)), bits)
    some = np.flatnonzero(total)
    yield _shared_rows(True, some, total[some], np.zeros((len(some), 4), _U))


def _arrow(df: DataFrame):
    return df.toArrow().combine_chunks()


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the standardised features and the constant, by Newton steps with a slight ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-2 * w
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), slope)
    return w


@dataclass
class Model:
    words: Words | None
    ratios: Ratios | None
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    share: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.ratios is None:
            return np.full(len(texts), self.share)
        x = (features(self.words, self.ratios, texts) - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ self.weights, -30, 30)))


def _chosen(work: Workspace, texts: DataFrame, known: DataFrame, sample: int) -> DataFrame:
    """The labelled rows to learn from, with their texts: of each class the first `sample` by the hash of their ids, up to
    the one with which SAMPLE_BYTES are reached."""
    ids = known.where("toxic = 0").orderBy("hash", "key").limit(sample).unionByName(
        known.where("toxic = 1").orderBy("hash", "key").limit(sample))
    ids = work.keep(ids, "ids")
    narrow = work.keep(texts.select("key", F.xxhash64("text").alias("of_text"), F.octet_length("text").alias("bytes")).join(
        F.broadcast(ids), "key"), "narrow")  # 2 * sample ids
    rows = [narrow.where(F.col("toxic") == t).groupBy("toxic", "hash", "key", "of_text").agg(
        F.max("bytes").alias("bytes")).orderBy("hash", "key", "of_text").limit(sample) for t in (0, 1)]
    before = F.coalesce(F.sum("bytes").over(Window.partitionBy("toxic").orderBy("hash", "key", "of_text").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows[0].unionByName(rows[1]).withColumn("before", before).where(F.col("before") < SAMPLE_BYTES)
    rows = work.keep(rows.drop("before", "bytes"), "rows")
    return work.keep(texts.withColumn("of_text", F.xxhash64("text")).join(F.broadcast(rows), ["key", "of_text"]).groupBy(
        "toxic", "hash", "key", "of_text").agg(F.first("text").alias("text")), "sample")


def _word_model(work: Workspace, seen: DataFrame, docs: DataFrame) -> tuple[Words | None, np.ndarray]:
    """The model of words, and the counts of pairs of bytes over all documents."""
    pairs = work.keep(seen.select("toxic", "text").mapInArrow(
        tidy(_word_pairs), "toxic int, before bigint, after bigint, n bigint").groupBy("toxic", "before", "after").agg(
        F.sum("n").alias("n")), "pairs")
    kept = F.when(F.col("n") >= PAIR_MIN, F.col("n"))
    kinds = pairs.groupBy("toxic", F.col("after").alias("word")).agg(F.count(F.lit(1)).alias("kinds"))
    words = _arrow(kinds.where(F.col("kinds") >= WORD_MIN))
    all_kinds = {r["toxic"]: r["count"] for r in pairs.groupBy("toxic").count().collect()}
    contexts = _arrow(pairs.groupBy("toxic", F.col("before").alias("context")).agg(
        F.sum("n").alias("all"), F.coalesce(F.sum(kept), F.lit(0)).alias("kept"), F.count(kept).alias("kept_kinds")))
    often = _arrow(pairs.where(F.col("n") >= PAIR_MIN))
    counts: list[dict] = [{"all_kinds": all_kinds.get(1, 0)}, {"all_kinds": all_kinds.get(0, 0)}]
    for table in (words, contexts, often):
        label = np.asarray(table["toxic"])
        for i, t in enumerate((1, 0)):
            for name in table.schema.names[1:]:
                column = np.asarray(table[name])[label == t]
                counts[i][name] = column.view(_U) if name in ("word", "context", "before", "after") else column.astype(float)
    merged = docs.select("text").mapInArrow(tidy(_shared_counts), _SHARED).groupBy("spelt", "name").agg(
        F.sum("n").alias("n"), *(F.bit_or(f"m{i}").alias(f"m{i}") for i in range(4)))
    bits = sum((F.bit_count(f"m{i}") for i in range(1, 4)), F.bit_count("m0"))
    number = F.element_at(F.array(*(F.lit(int(n)).cast("bigint") for n in neighbours_by_bits())), bits.cast("int") + 1)
    shared = work.keep(merged.select("spelt", "name", F.when(F.col("spelt"), F.col("n")).otherwise(number).alias("n")), "shared")
    spelt = _arrow(shared.where("spelt").select("name", "n"))
    table = np.zeros(1 << 16)
    table[np.asarray(spelt["name"])] = np.asarray(spelt["n"])
    if not all(c["all_kinds"] for c in counts):
        return None, table.reshape(256, 256)
    total = shared.where("NOT spelt").agg(F.sum("n").alias("n")).first()["n"]
    wanted = F.broadcast(kinds.where(F.col("kinds") >= WORD_MIN).select(F.col("word").alias("name")).unionByName(
        pairs.where(F.col("n") >= PAIR_MIN).select(F.col("after").alias("name"))).distinct())  # words of the sample
    own = _arrow(shared.where("NOT spelt").join(wanted, "name").select("name", "n"))
    names, numbers = np.asarray(own["name"]).view(_U), np.asarray(own["n"]).astype(float)
    order = np.argsort(names)
    return Words.of(counts, names[order], numbers[order], total), table.reshape(256, 256)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_key: str = "doc_id",
        label: str = "toxic", sample: int = SAMPLE) -> Model:
    spark = docs.sparkSession
    importable(spark)
    known = labels.select(F.col(label_key).alias("key"), F.col(label).cast("int").alias("toxic")).where(
        "key IS NOT NULL AND toxic IN (0, 1)").distinct()
    known = known.where(~held_out(F.col("key"))).withColumn("hash", F.xxhash64("key"))
    number = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = number.get(1, 0) / max(1, sum(number.values()))
    flat = Model(None, None, np.zeros(2), np.ones(2), np.zeros(3), share)
    if len(number) < 2:
        return flat
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    with Workspace(spark) as work:
        chosen = _chosen(work, texts, known, sample)
        later = F.pmod("hash", F.lit(CALIBRATION)) == 0
        words, pairs = _word_model(work, chosen.where(~later), texts)
        if words is None:
            return flat
        counts = _arrow(chosen.where(~later).select("toxic", "text").mapInArrow(
            tidy(_gram_counts), "toxic int, gram bigint, n bigint").groupBy("toxic", "gram").agg(F.sum("n").alias("n")))
        toxic, gram, n = (np.asarray(counts[c]) for c in ("toxic", "gram", "n"))
        ratios = Ratios.of(*[(gram[toxic == t].view(_U), n[toxic == t]) for t in (1, 0)], pairs)
        given = spark.sparkContext.broadcast((words, ratios))

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = features(*given.value, batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                                 names=["toxic", "told", "spelt"])

        seen = _arrow(chosen.where(later).select("toxic", "text").mapInArrow(
            tidy(measured), "toxic int, told double, spelt double"))
    y, x = np.asarray(seen["toxic"]).astype(float), np.c_[np.asarray(seen["told"]), np.asarray(seen["spelt"])]
    if len(set(y.tolist())) < 2:
        return flat
    order = np.lexsort((x[:, 1], x[:, 0], y))  # sums do not depend on how the rows came
    y, x = y[order], x[order]
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    # The sample may have more toxic rows than there are; each class counts as it occurs.
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(words, ratios, centre, scale, _logistic(np.c_[(x - centre) / scale, np.ones(len(x))], y, weight), share)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the score of each whole text; a column of that name is replaced."""
    spark = docs.sparkSession
    importable(spark)
    given = spark.sparkContext.broadcast(model)  # bounded by the sample
    carried = [c for c in docs.columns if c != out]
    fields = "".join(f"`{c.replace('`', '``')}` {t}, " for c, t in docs.dtypes if c != out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], pa.array(given.value.scores(batch.column(text)))], names=[*carried, out])

    return docs.mapInArrow(tidy(run), f"{fields}`{out}` double")
