"""The text functions and classifiers as SQL functions of a session, for users who write SQL.

They are made of built-in expressions (``CREATE FUNCTION ... RETURN``), so the optimiser sees through them. Rule tables
are arguments here as they are of the classifiers; the names come with a prefix.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from threadloom import rules
from threadloom.functions import text as tx
from threadloom.functions.regex import WORD, to_java, whole_words


def literal(value: str) -> str:
    for char, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n")):
        value = value.replace(char, escaped)
    return f"'{value}'"


def _array(values) -> str:
    return f"array({', '.join(map(literal, values))})"


def _fold(text: str) -> str:
    return f"translate(lower(coalesce({text}, '')), 'ıſ', 'is')"


def _first(cases, test, otherwise: str) -> str:
    """CASE over (result, patterns) in the given order."""
    whens = " ".join(f"WHEN {test(patterns)} THEN {literal(label)}" for label, patterns in cases)
    return f"CASE {whens} ELSE {otherwise} END"


def _hints(hints) -> str:
    return f"size(filter({_array(hints)}, h -> contains(concat(lower(coalesce(bio, '')), ' ', lower(coalesce(website, ''))), h)))"


def definitions(comment_rules=None, comment_default: str = rules.COMMENT_DEFAULT, degree_rules=None, academic=None,
                practical=None) -> dict[str, str]:
    """Name to what follows it in CREATE FUNCTION. NULL texts count as empty."""
    def any_of(patterns) -> str:
        return f"lower(coalesce(text, '')) RLIKE {literal('|'.join(map(to_java, patterns)))}"

    def degree_of(phrases) -> str:
        return f"{_fold('bio')} RLIKE {literal(whole_words(phrases))}"

    academic, practical = academic or rules.ACADEMIC_HINTS, practical or rules.PRACTICAL_HINTS
    words = f"regexp_extract_all(lower(coalesce(text, '')), {literal(WORD + '+')}, 0)"
    spaced = f"concat(' ', translate(array_join({words}, ' '), 'ıſ', 'is'), ' ')"
    tag_list = ("CASE WHEN startswith(coalesce(tags, ''), '<') AND endswith(tags, '>') THEN regexp_extract_all(tags, '<([^>]+)>', 1) "
                "ELSE regexp_extract_all(coalesce(tags, ''), '([^|]+)', 1) END")
    return {
        "comment_class": f"(text STRING) RETURNS STRING RETURN {_first(comment_rules or rules.COMMENT_RULES, any_of, literal(comment_default))}",
        "user_degree": f"(bio STRING) RETURNS STRING RETURN {_first(degree_rules or rules.DEGREE_RULES, degree_of, 'NULL')}",
        "user_type": f"(bio STRING, website STRING) RETURNS STRING RETURN CASE WHEN {_hints(academic)} > {_hints(practical)} THEN 'Academic' "
                     f"WHEN {_hints(practical)} > {_hints(academic)} THEN 'Practical Developer' ELSE 'Unknown' END",
        "words": f"(text STRING) RETURNS ARRAY<STRING> RETURN {words}",
        "sentence_count": "(text STRING) RETURNS INT RETURN greatest(1, regexp_count(coalesce(text, ''), '[.!?]+'))",
        "syllable_count": f"(text STRING) RETURNS INT RETURN regexp_count({spaced}, {literal(tx._SYLLABLE)})",
        "reading_ease": "(words INT, sentences INT, syllables INT) RETURNS DOUBLE RETURN "
                        "coalesce(206.835D - 1.015D * try_divide(words, sentences) - 84.6D * try_divide(syllables, words), 0D)",
        "link_count": f"(body STRING) RETURNS INT RETURN regexp_count(coalesce(body, ''), {literal(tx._LINK)})",
        "has_image": f"(body STRING) RETURNS BOOLEAN RETURN coalesce(body, '') RLIKE {literal(tx._IMAGE)}",
        "code_blocks": f"(body STRING) RETURNS ARRAY<STRING> RETURN regexp_extract_all(coalesce(body, ''), {literal(tx._CODE_BLOCK)}, 1)",
        "strip_tags": f"(html STRING) RETURNS STRING RETURN regexp_replace(coalesce(html, ''), {literal(tx._TAG)}, ' ')",
        "tag_list": f"(tags STRING) RETURNS ARRAY<STRING> RETURN {tag_list}",
        "tag_counts": f"(tags STRING) RETURNS TABLE (tag STRING, n BIGINT) RETURN SELECT tag, count(*) FROM "
                      f"(SELECT explode({tag_list}) AS tag) GROUP BY tag",
    }


def register(spark: SparkSession, prefix: str = "", **rule_tables) -> list[str]:
    """Makes the functions known to the session, replacing those of the same names; their names."""
    made = {f"{prefix}{name}": body for name, body in definitions(**rule_tables).items()}
    for name, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(made)
