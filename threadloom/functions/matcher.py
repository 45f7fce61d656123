"""Many plain patterns at once: an Aho-Corasick automaton as arrays of a plan, walked by a text's characters.

The cost grows with the text, not with the number of patterns. Built once when the plan is made.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.binding import constant, let

# Entries of the transition table that a plan carries; longer lists of patterns are tried one by one.
MAX_ENTRIES = 500_000


@cache
def automaton(patterns: tuple[str, ...]) -> Automaton:
    return Automaton(patterns)


class Automaton:
    """`goto[state * classes + class]` is the next state shifted by `bits`, and below it the number of the first pattern (in
    the given order) that ends there, or `none`. `classes_of` gives the class of each code point, and at its end that of
    all beyond; class 0 is in no pattern."""

    def __init__(self, patterns: Sequence[str]):
        alphabet = sorted({ord(c) for p in patterns for c in p})
        self.none = len(patterns)
        self.bits = self.none.bit_length()
        self.classes = len(alphabet) + 1
        class_of = {c: i + 1 for i, c in enumerate(alphabet)}
        self.classes_of = [class_of.get(c, 0) for c in range(max(alphabet, default=0) + 2)]
        children, best = [{}], [self.none]
        for number, pattern in enumerate(patterns):
            state = 0
            for c in pattern:
                into = children[state].setdefault(class_of[ord(c)], len(children))
                if into == len(children):
                    children.append({})
                    best.append(self.none)
                state = into
            best[state] = min(best[state], number)
        self.size = len(children) * self.classes
        if self.size > MAX_ENTRIES or len(children) << self.bits >= 1 << 31:
            self.goto = None
            return
        rows, fail = [[0] * self.classes for _ in children], [0] * len(children)
        todo = deque([0])
        while todo:
            state = todo.popleft()
            best[state] = min(best[state], best[fail[state]])
            for c in range(self.classes):
                into = children[state].get(c)
                if into is None:
                    rows[state][c] = rows[fail[state]][c] if state else 0
                else:
                    fail[into] = rows[fail[state]][c] if state else 0
                    rows[state][c] = into
                    todo.append(into)
        self.goto = [into << self.bits | best[into] for row in rows for into in row]
        self.start = best[0]  # an empty pattern ends everywhere


def first_contained(text: Column, patterns: Sequence[str]) -> Column:
    """Number of the first pattern, in the given order, that the text contains; NULL if it contains none."""
    if not patterns:
        return F.lit(None).cast("int")
    made = automaton(tuple(patterns))
    if made.goto is None:
        numbered = F.transform(constant(list(patterns), "array<string>"), lambda p, i: F.when(text.contains(p), i))
        return F.array_min(numbered)
    goto = constant(made.goto, "array<int>")
    classes_of = constant(made.classes_of, "array<int>")
    mask, last = (1 << made.bits) - 1, len(made.classes_of) - 1

    def class_of(char: Column) -> Column:
        return F.get(classes_of, F.least(F.ascii(char), F.lit(last)))

    # State and best so far in one number.
    def step(seen: Column, c: Column) -> Column:
        into = F.get(goto, F.shiftright(seen, made.bits) * F.lit(made.classes) + c)
        return let(into, lambda i: i.bitwiseAND(F.lit(~mask)).bitwiseOR(F.least(i.bitwiseAND(F.lit(mask)), seen.bitwiseAND(F.lit(mask)))))

    walked = F.aggregate(F.transform(F.split(text, ""), class_of), F.lit(made.start), step, lambda seen: seen.bitwiseAND(F.lit(mask)))
    # An empty text is one empty character to `split`; only an empty pattern is in it.
    return F.when(text != "", F.nullif(walked, F.lit(made.none))).when(
        (text == "") & F.lit(made.start < made.none), F.lit(made.start))
