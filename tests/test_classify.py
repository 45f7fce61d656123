import re

import pytest
from pyspark.sql import functions as F

from threadloom import rules
from threadloom.functions import text as tx
from threadloom.functions.regex import contains_any, count_matches, to_java, whole_words
from threadloom.operators import classify, places

COMMENTS = [
    ("This is wrong", "Critical"), ("let me debug this", "Critical"), ("cannot reproduce", "Critical"),
    ("wrongly put", "Improvement Suggestions"), ("why is that", "Clarification Seeking"),
    ("really?", "Clarification Seeking"), ("you should retry", "Improvement Suggestions"),
    ("conversion done", "Reproducibility / Failure Reports"), ("crashes on start", "Reproducibility / Failure Reports"),
    ("error message shown", "Reproducibility / Failure Reports"), ("duplicate of another", "Moderation / Policy Issues"),
    ("please edit the formatting", "Moderation / Policy Issues"), ("", "Improvement Suggestions"),
    (None, "Improvement Suggestions"), ("éwhy", "Improvement Suggestions"), ("PYTHON 3", "Reproducibility / Failure Reports"),
    ("it's off-topic", "Moderation / Policy Issues"), ("condensed duplicate", "Moderation / Policy Issues"),
]


def test_comment_class(evaluate):
    assert evaluate([t for t, _ in COMMENTS], classify.comment_class) == [c for _, c in COMMENTS]


BIOS = [
    ("i hold a phd", "PhD", "Academic"), ("dr. x", "PhD", "Unknown"), ("prof. smith", None, "Unknown"),
    ("prof.smith", "Professor", "Unknown"), ("professor and student", "Professor", "Academic"),
    ("graduate student", "MSc", "Unknown"), ("undergraduate", None, "Unknown"),
    ("researcher at a lab", "Researcher", "Academic"), ("software engineer, consultant", None, "Practical Developer"),
    ("gitlab developer", None, "Unknown"), ("engineer at a university", None, "Unknown"), ("masters", None, "Unknown"),
    ("Student of m.sc", "MSc", "Unknown"), ("", None, "Unknown"), (None, None, "Unknown"),
    ("\u017ftudent", "Student", "Unknown"),
]


def test_degree_and_user_type(evaluate):
    bios = [b for b, _, _ in BIOS]
    assert evaluate(bios, classify.degree) == [d for _, d, _ in BIOS]
    assert evaluate(bios, lambda c: classify.user_type(c, F.lit(""))) == [t for _, _, t in BIOS]
    assert evaluate(["x"], lambda c: classify.user_type(c, F.lit("https://GitLab.com"))) == ["Academic"]


CITIES = {
    "brazil": ["rio"], "canada": ["toronto"], "georgia (usa)": ["atlanta"], "germany": ["berlin"],
    "maldives": ["male"], "romania": ["bucharest"], "nigeria": ["lagos"], "united kingdom": ["london"],
    "venezuela": ["caracas"], "zambia": ["lusaka"],
}
LOCATIONS = [
    ("El Cerrito, CA", "usa", "North America"), ("Johnson City, TN, USA", "usa", "North America"),
    ("on the server farm", "unknown", "Unknown"), ("Berlin, DE", "usa", "North America"),
    ("Berlin, Germany", "germany", "Europe"), ("Georgia, USA", "usa", "North America"),
    ("Tbilisi, Georgia", "usa", "North America"), ("Tbilisi", "georgia", "Asia"), ("Georgia", "usa", "North America"),
    ("Atlanta", "georgia (usa)", "Unknown"), ("Bucharest, Romania", "oman", "Asia"), ("Lagos, Nigeria", "niger", "Africa"),
    ("Mogadishu, Somalia", "mali", "Africa"), ("Toronto, Canada", "canada", "North America"),
    ("Toronto, Ontario", "brazil", "South America"), ("Caracas", "usa", "North America"), ("Lusaka", "usa", "North America"),
    ("S\u00e3o Paulo", "unknown", "Unknown"), ("Mal\u00e9", "maldives", "Asia"), ("London,   UK", "united kingdom", "Europe"),
    ("Remote", "unknown", "Unknown"), ("", "unknown", "Unknown"), (None, "unknown", "Unknown"), ("  ", "unknown", "Unknown"),
    ("Port Moresby, Papua New Guinea", "guinea", "Africa"), ("x, uk, ny", "united kingdom", "Europe"),
    ("Uruguay or USA", "usa", "North America"), ("Espa\u00f1a", "unknown", "Unknown"), ("Paris, Texas", "usa", "North America"),
]


def country(table):
    return lambda c: F.array(*[places.country_and_continent(places.normalized_location(c), table)[k]
                               for k in ("country", "continent")])


def test_country_and_continent(evaluate):
    got = evaluate([t for t, _, _ in LOCATIONS], country(places.place_table(CITIES)))
    assert got == [[c, k] for _, c, k in LOCATIONS]


def test_place_table_from_a_full_dictionary(evaluate, spark):
    """The order of the dictionary decides, and a country without a continent is Unknown."""
    table = places.place_table_from({"b": ["town", "x"], "a": ["town"], "c": ["ville"]}, {"a": "A", "b": "B"})
    assert evaluate(["Old Town", "ville"], country(table)) == [["b", "B"], ["c", "Unknown"]]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(table)], "priority int, keyword string, country string, continent string")
    assert places.read_place_table(df) == table


def test_every_country_is_found_by_its_name_or_one_before_it(evaluate):
    table = places.place_table()
    priority = {k: i for i, (k, _, _) in reversed(list(enumerate(table)))}
    names = [c for names in rules.COUNTRIES_BY_CONTINENT.values() for c in names]
    for name, (found, _) in zip(names, evaluate(names, country(table))):
        expected = next((c for k, c, _ in table if k in name), "unknown")
        ruled = any(s in name for s in rules.US_STATES)
        assert found == ("usa" if ruled else expected), name
        assert name in priority


def reference_scores(text):
    """The rules of the topic classifier, spelled out with Python's own regexes."""
    low = text.lower()
    out = []
    for topic, groups in rules.TOPIC_PATTERNS.items():
        score = 0.0
        for phrases, weight in groups:
            score += len(re.findall(rf"\b(?:{'|'.join(phrases)})\b", low, re.I)) * weight
        out.append(score + 0.25 * len(set(re.findall(r"\w+", low)) & set(rules.TOPIC_KEYWORDS[topic])))
    return out


TOPIC_TEXTS = [
    "", "error error stack trace stack", "it doesn't work, it does not work: not working; fails", "how does it do how do",
    "what is whatis what is", "best way best best practice optimise optimize optimizer", "python 3 python3 python 3.8 python 33 net 4 internet5",
    "v1 v v12 v1a version versions", "v\u0663 java\u00a08", "\u0131nstall and \u017fervice, cra\u017fh", "null pointer null  pointer nullreference",
    "error_code error-code errors", "\u00e9error errore\u0301 error\u0301", "why why? WHY explain concept conceptual", "since removed legacy deprecated docker",
    "stack trace exception", "docker install config environment service", "php\t7 net\n4",
]


def topic_columns(c):
    lower = F.lower(c)
    fold = tx.fold(lower)
    words = classify.topic_words(tx.tokenize(lower))
    return classify.topic_scores(fold, classify.topic_words(tx.tokenize(fold)), words)


def test_topic_scores(evaluate):
    got = evaluate(TOPIC_TEXTS, lambda c: F.array(*topic_columns(c).values()))
    assert got == [pytest.approx(reference_scores(t)) for t in TOPIC_TEXTS]


def test_topic_threshold(spark):
    names = list(rules.TOPIC_PATTERNS)
    df = spark.createDataFrame([(0.0,) * 5, (2.0, 0.0, 0.0, 0.0, 0.0), (2.0, 1.7, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.45, 0.55)], names)
    category, confidence = classify.topic_class({n: F.col(n) for n in names})
    got = [tuple(r) for r in df.select(category, confidence).collect()]
    assert got == [("unknown", 0.0), ("debugging", 1.0), ("unknown", pytest.approx(2 / 3.7)), ("version_specific", 0.55)]


def test_overlapping_phrases_are_searched_as_one_pattern(evaluate):
    """"a b" and "b" share a word, so counting words on their own would count "b" twice."""
    patterns = {"t": [(["a b", "b"], 1.0)]}

    def score(c):
        words = classify.topic_words(tx.tokenize(c), patterns, {})
        return classify.topic_scores(c, words, words, patterns, {})["t"]
    assert evaluate(["a b b", "b a b", "x"], score) == [2.0, 2.0, 0.0]


CODE = [
    ("", "unknown"), ("def f(self):\n import x", "python"), ("select a from b", "sql"), ("var y", "javascript"),
    ("public static void main", "java"), ("using System; namespace x", "csharp"), ("zzz", "unknown"), ("None where", "python"),
]


def test_code_language(evaluate):
    assert evaluate([c for c, _ in CODE], classify.code_language) == [lang for _, lang in CODE]


def test_dialect(evaluate):
    """Java sees what Python's Unicode regexes see."""
    texts = ["caf\u00e9 x", "e\u0301a a", "dr. x", "dr.x", "x\u00a0y", "\u0663", "a_b", "", "wrong\u0301", "it's wrong"]
    for pattern in [r"\bx\b", r"\bdr\.?\b", r"\bdr\.\b", r"x\sy", r"\d", r"\w+", r"\bwrong\b", r"[\w ]+"]:
        expected = [len(re.findall(pattern, t)) for t in texts]
        assert evaluate(texts, lambda c: count_matches(c, to_java(pattern))) == expected, pattern
    for phrases in (["x", "dr"], [r"dr\.", "x"], ["wrong", "it"]):
        expected = [len(re.findall(rf"\b(?:{'|'.join(phrases)})\b", t)) for t in texts]
        assert evaluate(texts, lambda c: count_matches(c, whole_words(phrases))) == expected, phrases
    assert evaluate(texts, lambda c: contains_any(c, [r"\bx\b", "wrong", r"\."])) == [
        bool(re.search(r"\bx\b|wrong|\.", t)) for t in texts]
