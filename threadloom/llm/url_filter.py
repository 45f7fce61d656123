"""URLs judged by pattern rules that are indexed by their rarest literal token.

Every rule is a pattern over host and path; its literal tokens are the words that each URL it fits must have
whole. The rule is filed under the one that the fewest URLs have, counted over all URLs. A URL's own tokens
fetch the candidate rules, and only those run their regular expressions. Rules without a literal token are
candidates for every URL. Of the rules that fit, the longest wins, then block over allow, then the first.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; path: from there up to `?`, `#` or the
end. A null URL, and one without `://`, has an empty host and path, and no rule with a host fits it. The key is
only carried, so null and repeated keys do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.work import importable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile(r"[0-9A-Za-z]+")
#: Rules are broadcast, so their number is bounded.
MAX_RULES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """`pattern` must match host, line feed and path together; `tokens` are whole tokens of all it matches."""
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    length: int


def host_rule(verdict: str, rule: str) -> Rule:
    """`host/path`: that host and its subdomains, with paths that start with the path. The last token of the
    path may go on in the URL, so it is no literal token."""
    host, slash, path = rule.partition("/")
    path = slash + path
    whole = _TOKEN.findall(host) + [t[0] for t in _TOKEN.finditer(path) if t.end() < len(path)]
    return Rule(rule, verdict, rf"(?s)(?:.*\.)?{re.escape(host)}\n{re.escape(path)}", tuple(whole), len(rule))


RULES = [host_rule("allow", "org/"), host_rule("block", "example.org/es/"), host_rule("block", "example.org/en/1"),
         host_rule("allow", "com/fr/"), host_rule("block", "com/de/")]
#: Where no rule fits: printed pages are blocked, all else is allowed. `html` may go on in the URL, so it is no literal token.
DEFAULTS = [Rule("*.html", "block", r"(?s).*\n.*\.html", (), 0)]


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rarest(rules: list[Rule], counts: dict[str, int]) -> dict[str | None, list[int]]:
    """Rule numbers by the token they are filed under; None for those without one."""
    index: dict[str | None, list[int]] = {}
    for i, rule in enumerate(rules):
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
        index.setdefault(token, []).append(i)
    return index


class Judge:
    def __init__(self, rules: list[Rule], index: dict[str | None, list[int]]):
        self.rules, self.index = rules, index
        self.patterns = [re.compile(r.pattern) for r in rules]

    def best(self, host: str, path: str) -> Rule | None:
        tokens = dict.fromkeys([None, *_TOKEN.findall(host), *_TOKEN.findall(path)])
        text = f"{host}\n{path}"
        fits = [(-self.rules[i].length, self.rules[i].verdict != "block", i)
                for t in tokens for i in self.index.get(t, ()) if self.patterns[i].match(text)]
        return self.rules[min(fits)[2]] if fits else None


def judge_urls(df: DataFrame, key: str = "page_id", url: str = "url", rules: list[Rule] = RULES,
               defaults: list[Rule] = DEFAULTS) -> DataFrame:
    """One row per row: the key, host, path, rule (its name or null), verdict."""
    if len(rules) + len(defaults) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    spark = df.sparkSession
    importable(spark)
    parts = df.select(F.col(key).alias("key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    literal = sorted({t for r in [*rules, *defaults] for t in r.tokens})
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in literal], "token string"))
    tokens = F.array_distinct(F.regexp_extract_all(F.concat_ws("\n", "host", "path"), F.lit("[0-9A-Za-z]+"), 0))
    seen = parts.select(F.explode(tokens).alias("token")).join(wanted, "token")
    counts = {r["token"]: r["count"] for r in seen.groupBy("token").count().collect()}  # tokens of rules only
    given = spark.sparkContext.broadcast([(rs, rarest(rs, counts)) for rs in (rules, defaults)])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, otherwise = (Judge(*g) for g in given.value)
        for batch in batches:
            names, verdicts = [], []
            for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist()):
                rule = own.best(h, p)
                names.append(rule and rule.name)
                rule = rule or otherwise.best(h, p)
                verdicts.append(rule.verdict if rule else "allow")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=[*batch.schema.names, "rule", "verdict"])

    kind = parts.schema["key"].dataType.simpleString()
    out = parts.mapInArrow(judged, f"key {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("key", key)
