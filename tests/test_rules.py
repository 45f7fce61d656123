"""Every alternative of the comment rules, with a hit and a near miss written out by hand."""

import pytest

from threadloom.operators import classify

D = "Improvement Suggestions"
CRITICAL, CLARIFY, REPRO, POLICY = ("Critical", "Clarification Seeking", "Reproducibility / Failure Reports", "Moderation / Policy Issues")
CASES = [
    ("it is wrong", CRITICAL, "it is wrongly put", D), ("incorrect", CRITICAL, "incorrectly", D), ("not true", CRITICAL, "not tru", D),
    ("that's false", CRITICAL, "that is false", D), ("no, it", CRITICAL, "no it", D), ("debugger", CRITICAL, "bu g", D),
    ("mistaken", CRITICAL, "mistak", D), ("error in it", CRITICAL, "error on it", D), ("actually, yes", CRITICAL, "actually yes", D),
    ("cannot", CRITICAL, "can not", D), ("can't be", CRITICAL, "can't", D),
    ("why", CLARIFY, "whys", D), ("how", CLARIFY, "show", D), ("what do you mean", CLARIFY, "what do you meant", D),
    ("can you clarify", CLARIFY, "can you clarifyx", D), ("which one", CLARIFY, "which ones", D),
    ("are you saying", CLARIFY, "are you sayings", D), ("so?", CLARIFY, "so", D),
    ("you should x version", D, "you shoulder the version", REPRO), ("it's better to version", D, "it's better tom version", REPRO),
    ("preferably version", D, "preferablyx version", REPRO), ("consider a version", D, "considered version", REPRO),
    ("instead you can version", D, "instead you canvas the version", REPRO),
    ("use x rather than y version", D, "use z rather than y version", REPRO), ("suggest version", D, "sugges version", REPRO),
    ("doesn't work", REPRO, "doesn't works", D), ("not working", REPRO, "not workin", D), ("fails on", REPRO, "fails in", D),
    ("error message", REPRO, "error messag", D), ("conversion", REPRO, "versio", D),
    ("environments", REPRO, "environmen", D), ("python 3", REPRO, "python three", D), ("crashes", REPRO, "acrash", D),
    ("off-topic", POLICY, "off-topics", D), ("duplicates", POLICY, "duplicat", D), ("flagged", POLICY, "flag", D),
    ("please edit", POLICY, "please, edit", D), ("follow the rules", POLICY, "follow the rule", D),
    ("formatting", POLICY, "formattin", D), ("too broad", POLICY, "to broad", D), ("condense", POLICY, "condensed", D),
]


@pytest.mark.parametrize("column", [0, 2])
def test_comment_rules(evaluate, column):
    texts = [c[column] for c in CASES]
    assert evaluate(texts, classify.comment_class) == [c[column + 1] for c in CASES]
