"""Regex dialect helper.

The rules are stated in the Unicode dialect of Python's ``re``: ``\\w`` is any
letter, number or underscore (no combining marks), ``\\d`` any decimal digit and
``\\s`` any Unicode whitespace.  Spark evaluates regexes with ``java.util.regex``,
where the same escapes mean something narrower, so every rule table goes through
:func:`to_java` once, when the plan is built.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The inner class is implied by the outer one; Java tests it first, as a bit set,
# and most characters of most texts need no Unicode category lookup then.
WORD = r"[[abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_]\p{L}\p{N}]"
SPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
DIGIT = r"\p{Nd}"
LINE_BREAK = r"\n\x0b\f\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}"
STARTS_WORD = f"(?<!{WORD})"
ENDS_WORD = f"(?!{WORD})"
EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

_ESCAPES = {"w": WORD, "d": DIGIT, "s": SPACE}
_META = re.compile(r"[.^$*+?{}\[\]|()\\]")


def to_java(pattern: str) -> str:
    """Translate a rule pattern; ``\\b`` next to a plain letter needs one lookaround only."""
    out = []
    parts = re.findall(r"\\.|.", pattern, flags=re.S)
    for i, part in enumerate(parts):
        if part == r"\b":
            before = parts[i - 1] if i else ""
            after = parts[i + 1] if i + 1 < len(parts) else ""
            if _is_word_char(after):
                out.append(STARTS_WORD)
            elif _is_word_char(before):
                out.append(ENDS_WORD)
            else:
                out.append(EDGE)
        elif part[0] == "\\" and part[1] in _ESCAPES:
            out.append(_ESCAPES[part[1]])
        else:
            out.append(part)
    return "".join(out)


def whole_words(phrases: Iterable[str]) -> str:
    """One pattern for ``\\b(a|b|...)\\b``, alternatives tried in the given order.

    When every phrase starts with a plain character the pattern first tests that
    character: most positions of a text fail there, before any lookbehind runs.
    """
    phrases = list(phrases)
    firsts = {p[0] for p in phrases}
    if all(_is_word_char(c) for c in firsts):
        start = f"(?=[{''.join(sorted(firsts))}]){STARTS_WORD}"
    else:
        start = EDGE
    end = ENDS_WORD if all(_ends_in_word(p) for p in phrases) else EDGE
    return f"{start}(?:{'|'.join(to_java(p) for p in phrases)}){end}"


def literal_of(pattern: str) -> str | None:
    """The text a pattern matches if it has no regex construct, else None."""
    bare = re.sub(r"\\([^A-Za-z0-9])", "", pattern)
    return None if _META.search(bare) else re.sub(r"\\(.)", r"\1", pattern)


def contains_any(text: Column, patterns: Iterable[str]) -> Column:
    """True if any pattern occurs.

    Plain text is searched bytewise.  A pattern of plain text and word edges is tried
    as a regex only where its longest plain part occurs; the others form one regex.
    """
    tests, regexes = [], []
    for p in patterns:
        literal, core = literal_of(p), _core_of(p)
        if literal is not None:
            tests.append(text.contains(literal))
        elif core:
            tests.append(text.contains(core) & text.rlike(to_java(p)))
        else:
            regexes.append(to_java(p))
    if regexes:
        tests.append(text.rlike("|".join(regexes)))
    return reduce(lambda a, b: a | b, tests)


def _core_of(pattern: str) -> str | None:
    """Longest plain part of a pattern without choice, repetition or groups."""
    parts = [literal_of(part) for part in re.split(r"\\[bdsw]", pattern)]
    return None if None in parts else max(parts, key=len)


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def count_many(text: Column, pattern: str) -> Column:
    """The same for a pattern without groups that matches all over the text.

    Spark collects the matches to count them; asking for a group that never takes
    part in a match keeps it from copying each one.  The group stands at the end,
    where it costs nothing at the positions that do not match.
    """
    return F.size(extract_all(text, f"{pattern}(?:(?!)())?"))


def extract_all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _is_word_char(part: str) -> bool:
    return len(part) == 1 and part.isascii() and (part.isalnum() or part == "_")


def _ends_in_word(phrase: str) -> bool:
    return bool(re.search(r"(?:^|[^\\])[A-Za-z0-9_]$|\\d\+?$", phrase))
