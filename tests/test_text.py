import html
import math
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.functions import tags as tg
from threadloom.functions import text as tx


ENTITY_CASES = [
    "", "no entity", "a &amp; b", "&lt;b&gt;", "&amp;lt;", "&&amp;&", "&notit;", "&notin;", "&ampx", "&amp", "&AMP;x",
    "&copy 2", "&eacute;t&eacute", "&hellip;", "&CounterClockwiseContourIntegral;", "&unknown;", "&#65;", "&#65",
    "&#x41;", "&#X1F600;", "&#0;", "&#128;", "&#x80", "&#x81;", "&#13;", "&#xD800;", "&#1114112;", "&#99999999999999;",
    "&#x110000;", "&#xfffffffff;", "&#1;", "&#11;", "&#xFFFE;", "&#xFDD0;", "&#x1c;", "&#;", "&#x;", "&#xg;", "& amp;",
    "&#000000000000065;", "&#x000000000041;", "x&quot;y&apos;z", "&nbsp;|", "&lt", "&ltimes;", "&fjlig;", "&1;", "&é;",
]


def test_unescape_cases(evaluate):
    assert evaluate(ENTITY_CASES, tx.unescape) == [html.unescape(s) for s in ENTITY_CASES]


def test_unescape_every_named_reference(evaluate):
    from html.entities import html5
    cases = [f"x&{name}y &{name}" for name in html5]
    assert evaluate(cases, tx.unescape) == [html.unescape(s) for s in cases]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(
    ["&", "#", "x", ";", "amp", "lt", "not", "it", "0", "6", "5", "8", "A", " ", "<", "é", "copy", "\n"]), max_size=12),
    min_size=50, max_size=200))
def test_unescape_random(evaluate, pieces):
    cases = ["".join(p) for p in pieces]
    assert evaluate(cases, tx.unescape) == [html.unescape(s) for s in cases]


def test_normalize_text(evaluate):
    cases = [None, "", "  A  B\t\nc ", "São Paulo", "ﬁne &amp; ½", "&lt;p&gt;Hi&lt;/p&gt;", " x\u0085", "İ Σ ΑΣ", "Ⅷ ㎏ ｶﾞ 각"]

    def expected(s):
        s = unicodedata.normalize("NFKD", html.unescape(s or ""))
        return re.sub(r"\s+", " ", s.strip().lower())
    assert evaluate(cases, tx.normalize_text) == [expected(s) for s in cases]


def test_nfkd_all_of_the_basic_plane(evaluate):
    chars = [chr(c) for c in range(0x80, 0x3000) if unicodedata.category(chr(c)) != "Cn"]
    assert evaluate(chars, tx.nfkd) == [unicodedata.normalize("NFKD", c) for c in chars]


def test_html_to_text(evaluate):
    cases = ["<abbr>x</abbr><b>y</b>", "a&lt;div&gt;b", "<pre><code>x</code></pre>", "<PRE>x</PRE>", "1 < 2 > 0", "<b", "</a><i\nx>k"]
    assert evaluate(cases, tx.html_to_text) == [
        "<abbr>x</abbr> y ", "a b", "<pre><code>x</code></pre>", " x ", "1 < 2 > 0", "<b", "</a> k"]


def test_code_blocks(evaluate):
    body = "<pre><code>a\n\n  b c</code></pre> t <PRE><CODE>\n \n</CODE></PRE><pre class='x'><code>n</code></pre>"
    assert evaluate([body, "", "x"], lambda c: F.size(tx.code_blocks(c))) == [2, 0, 0]
    assert evaluate([body, "", "x"], lambda c: tx.non_blank_lines(tx.code_blocks(c))) == [3, 0, 0]


def test_links_and_images(evaluate):
    cases = ['<a href="x"><A\n HREF=', '<a class="k" href="n">', '<img src="i">', '<IMG SRC=', '<img alt="" src="x">']
    assert evaluate(cases, tx.link_count) == [2, 0, 0, 0, 0]
    assert evaluate(cases, tx.has_image) == [False, False, True, True, False]


WORD_CASES = ["", "one. Two! three?!", "rhythm brr tsk", "éa éa", "a_b 12 x1", "ſound ıt", "Don't stop...", "hmm² ⅷ"]


def test_words_and_sentences(evaluate):
    tokens = [re.findall(r"\w+", s.lower()) for s in WORD_CASES]
    assert evaluate(WORD_CASES, tx.tokenize) == tokens
    assert evaluate(WORD_CASES, tx.sentence_count) == [max(1, len(re.findall(r"[.!?]+", s))) for s in WORD_CASES]


def syllables(text):
    return sum(max(1, len(re.findall("[aeiouy]+", w, re.I))) for w in re.findall(r"\w+", text.lower()))


def test_syllables_equal_the_sum_over_words(evaluate):
    assert evaluate(WORD_CASES, lambda c: tx.syllable_count(tx.tokenize(c))) == [syllables(s) for s in WORD_CASES]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abeiyzé_1 .ıſ́-", max_size=20), min_size=50, max_size=200))
def test_syllables_random(evaluate, cases):
    assert evaluate(cases, lambda c: tx.syllable_count(tx.tokenize(c))) == [syllables(s) for s in cases]
    assert evaluate(cases, lambda c: F.size(tx.tokenize(c))) == [len(re.findall(r"\w+", s.lower())) for s in cases]


def test_flesch(spark):
    df = spark.sql("select * from values (0,1,0),(10,2,15) t(w,s,y)")
    got = [r[0] for r in df.select(tx.flesch_reading_ease(F.col("w"), F.col("s"), F.col("y"))).collect()]
    assert got == [0.0, 206.835 - 1.015 * 5.0 - 84.6 * 1.5]


TAG_CASES = [None, "", "<c#><.net>", "|a|a|b|", "|sql||join|", "plain", "<a>|b", "|x|"]


def test_tags(evaluate):
    assert evaluate(TAG_CASES, tg.tags_to_list) == [
        [], [], ["c#", ".net"], ["a", "a", "b"], ["sql", "join"], ["plain"], ["<a>", "b"], ["x"]]
    got = evaluate(TAG_CASES, lambda c: tg.tag_entropy(tg.tags_to_list(c)))
    assert got == pytest.approx([0, 0, 1, 0.9182958340544896, 1, 0, 1, 0])
    assert all(math.copysign(1, g) == 1 for g in got)


def test_syllables_of_long_runs_and_odd_words(evaluate):
    import random
    import re
    rng = random.Random(3)
    texts = ["a" * n for n in range(1, 40)] + ["", "b", "b c", "bcd a xyz", "ß é y", "_1_ 22", "eau oui aïe"]
    texts += [" ".join("".join(rng.choice("aeiouybcdß_1é") for _ in range(rng.randrange(1, 14))) for _ in range(rng.randrange(30))) for _ in range(200)]
    wanted = [sum(max(1, len(re.findall("[aeiouy]+", w))) for w in re.findall(r"\w+", t)) for t in texts]
    assert evaluate(texts, lambda c: tx.syllable_count(tx.tokenize(c))) == wanted


def test_syllables_of_a_folded_text_are_those_of_its_words(evaluate):
    import random
    rng = random.Random(5)
    texts = ["", " ", "b", "b-c", "bcd, a.xyz", "ıſı bſc ı", "ßcd é y'y", "_1_ 22!", "κλμ яе 𝒜b 𐐨", "áe x́y", "e" * 40]
    texts += ["".join(rng.choice("aeiouybcdtß_1éıſя .,-'\n") for _ in range(rng.randrange(60))) for _ in range(300)]
    words = evaluate(texts, lambda c: tx.syllable_count(tx.tokenize(c)))
    assert evaluate(texts, lambda c: tx.syllable_count_of(tx.fold(F.lower(c)), tx.words_of(F.lower(c)))) == words


def test_features_lower_each_text_once_and_count_syllables_in_it(spark):
    from threadloom.plans.posts import post_texts, posts_features
    from threadloom.schemas import POSTS, raw_schema
    raw = spark.createDataFrame([], raw_schema(POSTS))
    tokens = post_texts(raw)._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract_all(lower(" not in tokens
    assert tx._SYLLABLE not in posts_features(raw)._jdf.queryExecution().analyzed().toString()
