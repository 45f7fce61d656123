"""First contained pattern, against looking for each."""

import random

import pytest

from threadloom.functions import matcher
from threadloom.functions.matcher import first_contained


def brute(text, patterns):
    return None if text is None else next((i for i, p in enumerate(patterns) if p in text), None)


@pytest.mark.parametrize("alphabet", ["ab", "abc é", "aßİ漢😀", "georgia, us"])
@pytest.mark.parametrize("count", [1, 7, 300])
@pytest.mark.parametrize("fits", [True, False])
def test_random_patterns(evaluate, monkeypatch, alphabet, count, fits):
    if not fits:
        monkeypatch.setattr(matcher, "MAX_ENTRIES", 3)
        monkeypatch.setattr(matcher, "automaton", matcher.Automaton)
    rng = random.Random(count)
    patterns = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 7))) for _ in range(count)]
    texts = ["".join(rng.choice(alphabet + "zü") for _ in range(rng.randrange(25))) for _ in range(150)] + ["", None]
    assert evaluate(texts, lambda c: first_contained(c, patterns)) == [brute(t, patterns) for t in texts]


def test_odd_lists(evaluate):
    texts = ["abc", "", None, "x"]
    for patterns in ([], [""], ["x", ""], ["abc", "b", "abc"], ["bc", "abc", "abcd"]):
        assert evaluate(texts, lambda c, p=patterns: first_contained(c, p)) == [brute(t, patterns) for t in texts]


def test_long_text_is_walked_once(evaluate):
    assert evaluate(["a" * 200_000 + "b"], lambda c: first_contained(c, ["a" * 50 + "c", "a" * 50 + "b"])) == [1]
