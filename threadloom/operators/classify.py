"""Rule classifiers as column expressions: topic, code language, comment, user type, degree."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import rules
from threadloom.functions.binding import constant, let
from threadloom.functions.regex import contains_any, count_matches, to_java, whole_words
from threadloom.functions.text import fold


# ---- posts ----------------------------------------------------------------------

def keyword_hits(tokens: Column, keywords: list[str], stopwords=rules.STOPWORDS) -> Column:
    """How many keywords are among the tokens, stopwords aside.

    Taking the stopwords out of the keywords once gives the same number as taking
    them out of every token set.
    """
    kept = [k for k in keywords if k not in set(stopwords)]
    return F.size(F.array_intersect(tokens, F.array(*map(F.lit, kept)))) if kept else F.lit(0)


def topic_words(tokens: Column, patterns=None, keywords=None) -> Column:
    """The tokens that can count for a topic, in order and with repeats: a few of a long text."""
    patterns, keywords = patterns or rules.TOPIC_PATTERNS, keywords or rules.TOPIC_KEYWORDS
    words = {w for words in keywords.values() for w in words}
    shapes = set()
    for groups in patterns.values():
        for phrases, _ in groups:
            single, shaped, longer = _by_kind(phrases)
            words.update(single, *map(_first_word, longer))
            shapes.update(shaped)
    return F.filter(tokens, lambda t: reduce(
        lambda a, b: a | b, [t.isin(sorted(words)), *[_has_shape(t, s) for s in sorted(shapes)]]))


def topic_scores(folded: Column, folded_words: Column, words: Column, patterns=None,
                 keywords=None) -> dict[str, Column]:
    """Per topic: pattern matches times weight, in order, then keywords.

    ``folded`` is the lower-cased text (see ``functions.text.fold``), ``folded_words``
    its :func:`topic_words`, ``words`` those of the text before folding.  A phrase of
    one word is counted among the words; the text is searched for the others, and
    only if it contains how one of them begins.
    """
    patterns, keywords = patterns or rules.TOPIC_PATTERNS, keywords or rules.TOPIC_KEYWORDS
    scores = {}
    for topic, groups in patterns.items():
        score = F.lit(0.0)
        for phrases, weight in groups:
            score = score + _phrase_count(folded, folded_words, phrases) * F.lit(weight)
        scores[topic] = score + keyword_hits(words, keywords.get(topic, [])) * F.lit(rules.KEYWORD_WEIGHT)
    return scores


def _phrase_count(folded: Column, words: Column, phrases: list[str]) -> Column:
    """Whole-word matches of the phrases that do not overlap."""
    single, shaped, longer = _by_kind(phrases)
    counts = []
    if single or shaped:
        tests = ([_in(single)] if single else []) + [lambda t, s=s: _has_shape(t, s) for s in shaped]
        counts.append(F.size(F.filter(words, lambda t: reduce(lambda a, b: a | b, [test(t) for test in tests]))))
    if longer:
        counts.append(F.when(_may_occur(folded, words, longer), count_matches(folded, whole_words(longer)))
                      .otherwise(F.lit(0)))
    return reduce(lambda a, b: a + b, counts)


def _may_occur(folded: Column, words: Column, phrases: list[str]) -> Column:
    """Cheap test before a search: the first word of a phrase is there, or the text it begins with."""
    firsts = sorted({w for p in phrases for w in _first_word(p)})
    starts = sorted({_literal_start(p) for p in phrases if not _first_word(p)})
    tests = [F.arrays_overlap(words, F.array(*map(F.lit, firsts)))] if firsts else []
    if starts:
        tests.append(contains_any(folded, starts) if all(starts) else F.lit(True))
    return reduce(lambda a, b: a | b, tests)


def _first_word(phrase: str) -> list[str]:
    """The word a phrase begins with, if it ends within the plain part of the phrase."""
    return re.findall(r"^(\w+)[ ']", phrase)


def _in(words: list[str]):
    return lambda t: t.isin(words)


def _by_kind(phrases: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Plain words, patterns of one word, and phrases of several words.

    If a word of a phrase is itself in the group, matches could overlap: then all
    of the group is searched for in the text.
    """
    single = [p for p in phrases if re.fullmatch(r"\w+", p)]
    shaped = [p for p in phrases if re.fullmatch(r"(\w|\\d\+?)+", p) and p not in single]
    longer = [p for p in phrases if p not in single and p not in shaped]
    parts = {w for p in longer for w in re.findall(r"\w+", re.sub(r"\\[a-z]", " ", p))}
    if any(re.fullmatch(s, w) for w in parts for s in single + shaped):
        return [], [], list(phrases)
    return single, shaped, longer


def _has_shape(word: Column, pattern: str) -> Column:
    return word.startswith(_literal_start(pattern)) & word.rlike(f"^{to_java(pattern)}$")


def _literal_start(pattern: str) -> str:
    return re.match(r"[\w ']*", pattern)[0]


def topic_class(scores: dict[str, Column], threshold=rules.TOPIC_THRESHOLD) -> tuple[Column, Column]:
    """(category, confidence): the best share; below the threshold the name is
    ``unknown`` but the share is kept."""
    total = reduce(lambda a, b: a + b, scores.values())
    best = F.greatest(*scores.values())
    confidence = F.when(total > 0, F.try_divide(best, total)).otherwise(F.lit(0.0))
    named = reduce(lambda w, kv: w.when(kv[1] == best, F.lit(kv[0])), scores.items(), F)
    return F.when((total > 0) & (confidence >= threshold), named).otherwise(F.lit("unknown")), confidence


def code_language(code: Column, hints=None) -> Column:
    """Language with most hints occurring in the code; the first of equals; none gives ``unknown``."""
    hints = hints or rules.LANGUAGE_HINTS
    table = constant([{"language": k, "hints": v} for k, v in hints.items()],
                     "array<struct<language:string,hints:array<string>>>")

    def best(lowered: Column) -> Column:
        # The largest count, then the smallest position.
        return F.array_max(F.transform(table, lambda row, i: F.struct(
            F.size(F.filter(row["hints"], lambda h: lowered.contains(h))).alias("n"), (-i).alias("order"),
            row["language"].alias("language"))))

    named = let(let(F.lower(code), best), lambda b: F.when(b["n"] > 0, b["language"]).otherwise(F.lit("unknown")))
    return F.when(code == "", F.lit("unknown")).otherwise(named)


def guessed_language(tag_list: Column, blocks: Column, hints=None) -> Column:
    """The first tag, else what the first code block looks like."""
    return F.coalesce(F.lower(F.get(tag_list, F.lit(0))),
                      code_language(F.coalesce(F.get(blocks, F.lit(0)), F.lit("")), hints))


# ---- comments and users -----------------------------------------------------------

def comment_class(text: Column, table=None, default=rules.COMMENT_DEFAULT) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    chain = F
    for label, patterns in table or rules.COMMENT_RULES:
        chain = chain.when(contains_any(lowered, patterns), F.lit(label))
    return chain.otherwise(F.lit(default))


def user_type(bio: Column, website: Column, academic=None, practical=None) -> Column:
    text = F.concat(F.lower(F.coalesce(bio, F.lit(""))), F.lit(" "), F.lower(F.coalesce(website, F.lit(""))))
    lists = constant([academic or rules.ACADEMIC_HINTS, practical or rules.PRACTICAL_HINTS], "array<array<string>>")
    hits = let(text, lambda t: F.transform(lists, lambda hints: F.size(F.filter(hints, lambda h: t.contains(h)))))
    return let(hits, lambda n: F.when(n[0] > n[1], F.lit("Academic")).when(n[1] > n[0], F.lit("Practical Developer"))
               .otherwise(F.lit("Unknown")))


def degree(bio: Column, table=None) -> Column:
    """First degree whose pattern is in the bio; NULL if none."""
    text = fold(F.lower(F.coalesce(bio, F.lit(""))))
    chain = F
    for label, phrases in table or rules.DEGREE_RULES:
        chain = chain.when(text.rlike(whole_words(phrases)), F.lit(label))
    return chain
