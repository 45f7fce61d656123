"""Against the tiktoken library, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from threadloom.llm import byte_bpe
from threadloom.llm.queries import PATTERN, RANKS, op2_byte_bpe


@pytest.fixture(scope="module")
def ours():
    with open(RANKS, "rb") as f:
        return byte_bpe.Encoder(f.read(), PATTERN)


@pytest.fixture(scope="module")
def theirs():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefgh", "é漢a😀 ", "xy'12 \n", " \t\r\n\x0b\x85\u2028a", "the  'll1"])
@pytest.mark.parametrize("n", [0, 1, 2, 17, 300, 9000])
def test_random_texts(ours, theirs, alphabet, n):
    text = "".join(random.Random(n).choice(alphabet) for _ in range(n))
    ids = list(ours.encode(text))
    assert ids == theirs.encode_ordinary(text)
    with open(RANKS, "rb") as f:
        assert byte_bpe.Decoder(f.read()).decode(ids) == text.encode()


def test_every_class_of_character(ours, theirs):
    for cp in [*range(0x3000), *range(0x3000, 0x110000, 211), *byte_bpe.stand_ins()]:
        if not 0xD800 <= cp <= 0xDFFF:
            text = f"a{chr(cp)}b {chr(cp)} 1{chr(cp)}  {chr(cp)}'s"
            assert list(ours.encode(text)) == theirs.encode_ordinary(text), hex(cp)


def test_pre_token_longer_than_a_list(ours, theirs):
    text = "ab" * 30_000 + "c"
    assert list(ours.encode(text)) == theirs.encode_ordinary(text)


def test_many_pre_tokens_in_one_queue(ours, theirs):
    rng = random.Random(8)
    words = {"".join(rng.choice(a) for _ in range(rng.choice([2, 5, 12, 40]))) for a in ["a", "ab", "abcd", "é漢a", "theinsao"]
             for _ in range(400)}
    words = [w for w in sorted(words) if ours.split.findall(w) == [w] and w.encode() not in ours.rank]
    got = ours.encode_pieces([w.encode() for w in words])
    assert [memoryview(g).cast("i").tolist() for g in got] == [theirs.encode_ordinary(w) for w in words]
    assert got == [ours.encode_piece(w.encode()) for w in words]


def test_the_cache_may_fill(ours, theirs, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 3)
    text = " ".join(f"word{i % 7}x" for i in range(50))
    assert list(ours.encode(text)) == theirs.encode_ordinary(text)


def test_query_against_tiktoken(spark, sf, theirs):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = theirs.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest())


def test_nulls_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "héllo", [9], 2.5), (1, "héllo", None, None), (None, None, None, None), (3, "", [], 0.0)],
                               "`a b` int, text string, tokens array<int>, `decoded` double")
    out = byte_bpe.decode_tokens(byte_bpe.encode_texts(df, RANKS, PATTERN), RANKS)
    assert sorted(out.columns) == sorted(df.columns)
    assert sorted(bytes(r.decoded) for r in out.collect()) == [b"", b"", "héllo".encode(), "héllo".encode()]
    assert byte_bpe.decode_tokens(df.where("tokens IS NULL"), RANKS).count() == 2
    assert byte_bpe.encode_texts(df.where("false"), RANKS, PATTERN).count() == 0


def test_encoding_and_decoding_in_one_worker(spark):
    texts = ["", None, "hello  wörld 'll 123", "é漢퟿ x" * 50, "ab" * 3000]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "tokens_ int, text string, decoded_ string")
    both = byte_bpe.encode_and_decode(df, RANKS, PATTERN)
    one = byte_bpe.decode_tokens(byte_bpe.encode_texts(df, RANKS, PATTERN), RANKS)
    assert both.schema == one.schema and sorted(both.collect()) == sorted(one.collect())
    assert [bytes(r.decoded).decode() for r in both.orderBy("tokens_").collect()] == [t or "" for t in texts]


def test_a_worker_that_also_decodes_remembers_less(spark):
    with open(RANKS, "rb") as f:
        encoder = byte_bpe.Encoder(f.read(), PATTERN, cached=50)
    texts = [f"word{i} and wörd{i * 7} again{i % 9}" for i in range(1300)]
    for text in texts:
        encoder.learn(pa.array([text]))
        encoder.encode(text)
        assert len(encoder.seen) <= 100 and len(encoder.seen.older) <= 100
    df = spark.createDataFrame([*enumerate(texts)], "doc_id int, text string").coalesce(1)
    both = byte_bpe.encode_and_decode(df, RANKS, PATTERN).collect()
    alone = {r.doc_id: r.tokens for r in byte_bpe.encode_texts(df, RANKS, PATTERN).collect()}
    assert len(both) == len(texts)
    for r in both:
        assert r.tokens == alone[r.doc_id] and bytes(r.decoded).decode() == texts[r.doc_id]


@pytest.mark.parametrize(("cached", "at_once"), [(3, 2), (50, 7), (100_000, 500)])
def test_texts_of_a_batch_are_split_once(theirs, monkeypatch, cached, at_once):
    with open(RANKS, "rb") as f:
        encoder = byte_bpe.Encoder(f.read(), PATTERN, cached=cached)
    monkeypatch.setattr(byte_bpe, "_LONG", 3000)
    monkeypatch.setattr(byte_bpe, "_RUN", 2000)
    texts = [f"word{i} and wörd{i * 7} again{i % 9}  " + "x" * (i % 90) for i in range(60)]
    texts += [None, "", "é漢\uD7FF x" * 50, *byte_bpe.stand_ins().values(), "".join(map(chr, [*byte_bpe.stand_ins()][:40])),
              "long text " * 400, "again0"]
    split = []
    pieces = encoder._pieces
    monkeypatch.setattr(encoder, "_pieces", lambda text: split.append(text) or pieces(text))
    for _ in range(2):
        split.clear()
        got = [list(ids) for ids in encoder.encode_all(pa.array(texts), at_once)]
        assert got == [theirs.encode_ordinary(t or "") for t in texts]
        assert sorted(split) == sorted(t or "" for t in texts)
