import pytest

from threadloom.llm import url_filter as uf

CASES = [
    ("http://example.org/es/1", "example.org/es/", "block"), ("HTTPS://A.B.EXAMPLE.ORG/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "org/", "allow"), ("http://badexample.org/es/", "org/", "allow"), ("http://example.org", None, "allow"),
    ("http://example.org?x=/es/", None, "allow"), ("http://x.com/fr/9.html", "com/fr/", "allow"), ("http://x.com/de/9", "com/de/", "block"),
    ("http://x.com/frx", None, "allow"), ("http://x.net/a.html", None, "block"), ("http://x.net/a.htm", None, "allow"), ("x.org/es/", None, "allow"),
    (None, None, "allow"), ("", None, "allow"), ("http://org/a", "org/", "allow"), ("http://x.com/FR/1", None, "allow"),
    ("http://x.com:80/fr/1", None, "allow"), ("http://x.com/" + "a/" * 20_000, None, "allow")]


def test_verdicts(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(CASES)], "page_id bigint, url string").selectExpr("*", "1 AS host", "2 AS token")
    got = {r.page_id: (r.rule, r.verdict) for r in uf.judge_urls(df).collect()}
    assert got == {i: (rule, verdict) for i, (_, rule, verdict) in enumerate(CASES)}


def test_parts_null_keys_and_empty_table(spark):
    df = spark.createDataFrame([(None, "ftp://User@HoSt:1/Pa/th?q#f"), (None, "a://b://c/d")], "page_id bigint, url string")
    assert sorted((r.host, r.path) for r in uf.judge_urls(df).collect()) == [("b:", "//c/d"), ("user@host:1", "/Pa/th")]
    assert uf.judge_urls(df.where("false")).count() == 0


def test_rules_are_filed_under_their_rarest_token():
    rules = [uf.host_rule("block", "example.org/en/1"), uf.Rule("*", "allow", "(?s).*", (), 0)]
    assert rules[0].tokens == ("example", "org", "en")
    index = uf.rarest(rules, {"example": 9, "org": 50, "en": 3})
    assert index == {"en": [0], None: [1]}
    judge = uf.Judge(rules, index)
    assert judge.best("example.org", "/en/10").name == "example.org/en/1" and judge.best("example.org", "/es/").name == "*"


def test_the_index_finds_what_all_rules_would(spark):
    rules = uf.RULES
    judge = uf.Judge(rules, uf.rarest(rules, {}))
    for url, rule, _ in CASES:
        if url and "://" in url:
            host, slash, path = url.split("://", 1)[1].split("?")[0].lower().partition("/")
            fits = [r for r in rules if (host == r.name.split("/")[0] or host.endswith("." + r.name.split("/")[0]))
                    and (slash + path).startswith(r.name[r.name.index("/"):])]
            best = max(fits, key=lambda r: len(r.name), default=None)
            assert judge.best(host, slash + path) == best


def test_the_index_loses_no_rule_where_a_token_goes_on(spark):
    urls = [f"http://x.net{p}" for p in ("/a.html5", "/page.html2", "/x.htmlold", "/a.html", "/a.htm", "/html")] + ["http://org/a.html5"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for r in uf.judge_urls(df).collect():
        text, fits = f"{r.host}\n{r.path}", None
        for rules in (uf.RULES, uf.DEFAULTS):
            fits = fits or min((x for x in rules if uf.re.match(x.pattern, text)), key=lambda x: (-x.length, x.verdict != "block"), default=None)
        assert r.verdict == (fits.verdict if fits else "allow"), r
    assert [r.verdict for r in uf.judge_urls(df).orderBy("page_id").collect()] == ["block"] * 4 + ["allow"] * 3


def test_too_many_rules(spark, monkeypatch):
    monkeypatch.setattr(uf, "MAX_RULES", 2)
    with pytest.raises(ValueError):
        uf.judge_urls(spark.createDataFrame([], "page_id bigint, url string"))
