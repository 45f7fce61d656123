"""SQL counterparts of the registered queries, written for DuckDB on the same tables.

The word lists come from the rule tables; the logic is written on its own: words
are counted one by one, phrases are found by their separators, entities and tags
are replaced step by step.
"""

from __future__ import annotations

import re

from checks.queries import PLACES
from checks.shapes import BAD_POSTS_SQL, COMMENTS_SQL, POSTS_SQL, USERS_SQL, text_sql
from threadloom import rules

_W = r"[\p{L}\p{N}_]"
_N = r"[^\p{L}\p{N}_]"


def _list(values) -> str:
    return f"[{', '.join(map(text_sql, values))}]"


# ---- text -------------------------------------------------------------------------------

def _decode(text: str) -> str:
    """The references that occur in the tables; the ampersand comes last."""
    out = text
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        out = f"replace({out}, {text_sql(ref)}, {text_sql(char)})"
    return f"replace(replace(replace({out}, '&amp;', chr(1)), '&amp', chr(1)), chr(1), '&')"


def _strip_tags(text: str) -> str:
    """Tags to spaces; those to be kept are hidden behind control characters meanwhile."""
    kept = [("<pre", 2), ("</pre", 3), ("<code", 4), ("</code", 5), ("<a", 6), ("</a", 7)]
    out = text
    for tag, mark in kept:
        out = f"replace({out}, '{tag}', chr({mark}))"
    out = rf"regexp_replace({out}, '</?{_W}[^>]*>', ' ', 'g')"
    for tag, mark in kept:
        out = f"replace({out}, chr({mark}), '{tag}')"
    return out


def _words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_W}+')"


def _spaces(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def _nfkd(text: str) -> str:
    out = text
    for base, mark, chars in (("aeiou", "́", "áéíóú"), ("aeo", "̀", "àèò"), ("aeo", "̂", "âêô"),
                              ("aou", "̈", "äöü"), ("n", "̃", "ñ"), ("a", "̃", "ã"), ("c", "̧", "ç")):
        for b, c in zip(base, chars):
            out = f"replace({out}, '{c}', '{b}{mark}')"
    return out


def _normalize(text: str) -> str:
    return _nfkd(_spaces(f"lower({_decode(f'coalesce({text}, {text_sql(chr(0)[:0])})')})"))


_BLOCKS = "regexp_extract_all(\"Body\", '(?is)<pre><code>(.*?)</code></pre>', 1)"
_FIRST_BLOCK = f"coalesce({_BLOCKS}[1], '')"
_TAGS = """CASE WHEN starts_with(coalesce("Tags", ''), '<') AND ends_with("Tags", '>')
           THEN regexp_extract_all("Tags", '<([^>]+)>', 1)
           ELSE list_filter(string_split(coalesce("Tags", ''), '|'), lambda x: x <> '') END"""
_LINES = (f"CAST(list_sum(list_transform({_BLOCKS}, lambda b: len(list_filter(string_split_regex(b, '\\r\\n|[\\n\\r]'), "
          "lambda l: regexp_matches(l, '\\S'))))) AS INTEGER)")
_SYLLABLES = "list_sum(list_transform(words, lambda w: greatest(1, len(regexp_extract_all(w, '[aeiouy]+')))))"


def _count(text: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, {text_sql(pattern)})) AS INTEGER)"


def _links(body: str) -> str:
    n = _count(body, r"(?i)<a\s+href=")
    return (f"CAST({n} > 0 AS INTEGER) AS has_link, {n} AS external_link_count, "
            f"CAST(regexp_matches({body}, '(?i)<img\\s+src=') AS INTEGER) AS has_image")


def _entropy(tags: str) -> str:
    share = f"(len(list_filter({tags}, lambda y: y = d)) / CAST(len({tags}) AS DOUBLE))"
    return (f"CASE WHEN len({tags}) < 2 THEN 0.0::DOUBLE ELSE "
            f"0.0::DOUBLE - list_sum(list_transform(list_distinct({tags}), lambda d: {share} * log2({share}))) END")


def _flesch(words: str, sentences: str, syllables: str) -> str:
    return (f"CASE WHEN {words} = 0 THEN 0.0::DOUBLE ELSE 206.835::DOUBLE - 1.015::DOUBLE * "
            f"({words}::DOUBLE / {sentences}::DOUBLE) - 84.6::DOUBLE * ({syllables}::DOUBLE / {words}::DOUBLE) END")


# ---- classifiers --------------------------------------------------------------------------

def _language(code: str) -> str:
    scores = {lang: " + ".join(f"CAST(contains(lower({code}), {text_sql(h)}) AS INTEGER)" for h in hints)
              for lang, hints in rules.LANGUAGE_HINTS.items()}
    names = list(scores)
    best = f"greatest({', '.join(f'({scores[n]})' for n in names)})"
    whens = " ".join(f"WHEN ({scores[n]}) = {best} THEN '{n}'" for n in names)
    return f"CASE WHEN {best} = 0 THEN 'unknown' {whens} END"


# The separators of a text are doubled, so that two neighbouring phrases can each take one.
_DOUBLED = f"regexp_replace(lower(txt), '({_N})', '\\1\\1', 'g')"


def _phrase_count(phrases) -> str:
    def doubled(p: str) -> str:
        p = p.replace(r"\s*", r"(?:\s\s)*")
        return re.sub(r"([ '])", r"\1\1", p)
    body = "|".join(doubled(p) for p in phrases)
    return f"len(regexp_extract_all(doubled, {text_sql(f'(?:^|{_N})(?:{body})(?:$|{_N})')}))"


def _overlap(keywords) -> str:
    return f"len(list_intersect(words, {_list(keywords)}))"


_SCORES = ", ".join(
    "0.0::DOUBLE + " + " + ".join(f"{_phrase_count(p)} * {w}::DOUBLE" for p, w in groups)
    + f" + {_overlap(rules.TOPIC_KEYWORDS[topic])} * 0.25::DOUBLE AS {topic}"
    for topic, groups in rules.TOPIC_PATTERNS.items())
_TOPICS = list(rules.TOPIC_PATTERNS)
_TOTAL = "(" + " + ".join(_TOPICS) + ")"
_BEST = f"greatest({', '.join(_TOPICS)})"
_SHARE = f"CASE WHEN {_TOTAL} > 0 THEN {_BEST} / {_TOTAL} ELSE 0.0::DOUBLE END"
_CATEGORY = (f"CASE WHEN {_TOTAL} > 0 AND {_BEST} / {_TOTAL} >= 0.55::DOUBLE THEN CASE "
             + " ".join(f"WHEN {t} = {_BEST} THEN '{t}'" for t in _TOPICS) + " END ELSE 'unknown' END")

_TEXTS = f"""{POSTS_SQL},
texts AS (SELECT *, {_decode('coalesce("Title", ' + "'')")} AS title_text,
                 {_decode('coalesce("Title", ' + "'')")} || ' ' || {_strip_tags(_decode('"Body"'))} AS txt FROM v_posts),
worded AS (SELECT *, {_words("txt")} AS words, {_DOUBLED} AS doubled FROM texts),
scored AS (SELECT *, {_SCORES} FROM worded)"""

_FEATURES = f"""{_TEXTS},
features AS (
  SELECT CAST("Id" AS BIGINT) AS id, CAST("PostTypeId" AS TINYINT) AS posttypeid,
         CAST("ParentId" AS BIGINT) AS parentid, CAST("AcceptedAnswerId" AS BIGINT) AS acceptedanswerid,
         CAST("CreationDate" AS TIMESTAMP) AS creationdate, CAST("Score" AS INTEGER) AS score,
         CAST("ViewCount" AS INTEGER) AS viewcount, CAST("OwnerUserId" AS BIGINT) AS owneruserid,
         CAST("LastEditorUserId" AS BIGINT) AS lasteditoruserid, CAST("LastEditDate" AS TIMESTAMP) AS lasteditdate,
         CAST("LastActivityDate" AS TIMESTAMP) AS lastactivitydate,
         array_to_string({_TAGS}, '|') AS tags, CAST(len({_TAGS}) AS INTEGER) AS tagcount,
         {_entropy(f"({_TAGS})")} AS tag_entropy,
         substr(replace(title_text, '\\', '\\\\'), 1, 2000) AS title,
         substr(replace("Body", '\\', '\\\\'), 1, 2000) AS body,
         CAST(len(words) AS INTEGER) AS word_count,
         greatest(1, {_count("txt", "[.!?]+")}) AS sentence_count,
         {_flesch("len(words)", f'greatest(1, {_count("txt", "[.!?]+")})', _SYLLABLES)} AS flesch_reading,
         CAST(len({_BLOCKS}) AS INTEGER) AS code_block_count, coalesce({_LINES}, 0) AS code_total_lines,
         {_links('"Body"')},
         coalesce(lower(({_TAGS})[1]), {_language(_FIRST_BLOCK)}) AS guessed_lang,
         {_CATEGORY} AS category, {_SHARE} AS confidence
  FROM scored)"""


def _comment_class(classes, default) -> str:
    """First class of which a whole phrase, a piece of text or the pattern occurs."""
    cases = []
    for label, whole, anywhere, pattern in classes:
        tests = [f"contains(lower(\"Text\"), {text_sql(t)})" for t in anywhere]
        phrases = "|".join(whole)
        tests.append(f"regexp_matches(lower(\"Text\"), {text_sql(f'(?:^|{_N})({phrases})(?:$|{_N})')})")
        if pattern:
            tests.append(f"regexp_matches(lower(\"Text\"), {text_sql(pattern.replace('{N}', _N))})")
        cases.append(f"WHEN {' OR '.join(tests)} THEN {text_sql(label)}")
    return f"CASE {' '.join(cases)} ELSE {text_sql(default)} END"


# Written out here, not taken from the rules, so that a wrong rule shows.
_COMMENT_CLASS = _comment_class([
    ("Critical", ["wrong", "incorrect"],
     ["not true", "that's false", "no, it", "bug", "mistake", "error in", "actually,", "this is wrong", "cannot", "can't be"], ""),
    ("Clarification Seeking", ["why", "how", "what do you mean", "can you clarify", "which one", "are you saying"], ["?"], ""),
    ("Improvement Suggestions", ["you should", "it's better to"], ["use x rather than y", "suggest"],
     "(preferably|consider|instead you can)(?:$|{N})"),
    ("Reproducibility / Failure Reports", ["doesn't work"],
     ["not working", "fails on", "error message", "cannot reproduce", "version", "environment"], "python [0-9]|(?:^|{N})crash"),
    ("Moderation / Policy Issues", ["off-topic"],
     ["duplicate", "flagged", "please edit", "follow the rules", "formatting", "too broad"], "condense(?:$|{N})"),
], "Improvement Suggestions")


def _hints(text: str, hints) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, {text_sql(h)}) AS INTEGER)" for h in hints) + ")"


_BIO = _normalize('"AboutMe"')
_ABOUT = """bio || ' ' || lower("WebsiteUrl")"""
_USER_TYPE = (f"CASE WHEN {_hints(_ABOUT, rules.ACADEMIC_HINTS)} > {_hints(_ABOUT, rules.PRACTICAL_HINTS)} THEN 'Academic' "
              f"WHEN {_hints(_ABOUT, rules.ACADEMIC_HINTS)} < {_hints(_ABOUT, rules.PRACTICAL_HINTS)} "
              "THEN 'Practical Developer' ELSE 'Unknown' END")


def _degree_test(phrases) -> str:
    tests = []
    for p in phrases:
        # A dot at the end has to be followed by a word character; an optional one changes nothing.
        p = p.removesuffix(r"\.?")
        end = _W if p.endswith(r"\.") else f"(?:$|{_N})"
        tests.append(f"regexp_matches(bio, {text_sql(f'(?:^|{_N}){p}{end}')})")
    return " OR ".join(tests)


_DEGREE = "CASE " + " ".join(f"WHEN {_degree_test(p)} THEN '{d}'" for d, p in rules.DEGREE_RULES) + " END"

_PLACES = ",\n".join(f"({i}, {text_sql(k)}, {text_sql(c)}, {text_sql(n)})" for i, (k, c, n) in enumerate(PLACES))
_RULED = f"""
    WHEN loc = '' THEN 'unknown'
    WHEN regexp_matches(loc, '(?:^|{_N})georgia[, ]+usa(?:$|{_N})') THEN 'usa'
    WHEN list_contains({_list(rules.US_STATE_CODES)}, upper(regexp_extract(loc, ',\\s*([a-z][a-z])(?:$|{_N})', 1))) THEN 'usa'
    WHEN {" OR ".join(f"contains(loc, '{s}')" for s in rules.US_STATES)} THEN 'usa'
    WHEN contains(loc, 'tbilisi') OR contains(loc, 'batumi') THEN 'georgia'"""

_USERS = f"""{USERS_SQL},
normal AS (SELECT *, {_BIO} AS bio, {_normalize('"Location"')} AS loc FROM v_users),
places(priority, keyword, country, continent) AS (VALUES {_PLACES}),
locations AS (SELECT DISTINCT loc FROM normal),
first_place AS (SELECT loc, arg_min(country, priority) AS country, arg_min(continent, priority) AS continent
                FROM locations JOIN places ON contains(loc, keyword) GROUP BY loc),
placed AS (
  SELECT n.*, CASE {_RULED} ELSE coalesce(f.country, 'unknown') END AS "Country",
         CASE {_RULED.replace("'unknown'", "'Unknown'").replace("THEN 'usa'", "THEN 'North America'")
                .replace("THEN 'georgia'", "THEN 'Asia'")} ELSE coalesce(f.continent, 'Unknown') END AS "Continent"
  FROM normal n LEFT JOIN first_place f USING (loc)),
processed AS (
  SELECT CAST("Id" AS BIGINT) AS "Id", CAST("Reputation" AS INTEGER) AS "Reputation", "DisplayName",
         coalesce("Location", '') AS "Location", bio AS "AboutMe", {_USER_TYPE} AS "UserType", {_DEGREE} AS "Degree",
         "Country", "Continent", CAST("AccountId" AS BIGINT) AS "AccountId",
         CAST("CreationDate" AS TIMESTAMP) AS "CreationDate", CAST("LastAccessDate" AS TIMESTAMP) AS "LastAccessDate"
  FROM placed)"""

_PROCESSED_COMMENTS = f"""{COMMENTS_SQL},
processed AS (
  SELECT CAST("Id" AS BIGINT) AS "Id", CAST("PostId" AS BIGINT) AS "PostId", CAST("Score" AS INTEGER) AS "Score",
         "Text", CAST("CreationDate" AS TIMESTAMP) AS "CreationDate", CAST("UserId" AS BIGINT) AS "UserId",
         {_COMMENT_CLASS} AS "CommentClass"
  FROM v_comments)"""

_REASON = """nullif(concat_ws(';',
    CASE WHEN TRY_CAST("Id" AS BIGINT) IS NULL THEN 'bad Id' END,
    CASE WHEN TRY_CAST("PostTypeId" AS TINYINT) IS NULL THEN 'bad PostTypeId' END,
    CASE WHEN TRY_CAST("CreationDate" AS TIMESTAMP) IS NULL THEN 'bad CreationDate' END,
    CASE WHEN TRY_CAST("Score" AS INTEGER) IS NULL THEN 'bad Score' END), '')"""
_BAD = f"""{BAD_POSTS_SQL},
judged AS (SELECT *, {_REASON} AS error_reason FROM v_bad_posts)"""


def _xml(column: str) -> str:
    out = f'"{column}"'
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = f"replace({out}, {text_sql(char)}, {text_sql(ref)})"
    out = f"replace(replace(replace({out}, chr(10), '&#xA;'), chr(13), '&#xD;'), chr(9), '&#x9;')"
    return f"coalesce(' {column}=\"' || {out} || '\"', '')"


_COMMENT_LINE = "'<row' || " + " || ".join(
    _xml(c) for c in ("Id", "PostId", "Score", "Text", "CreationDate", "UserId")) + " || ' />'"

_SPLIT = ("SELECT * EXCLUDE (body) FROM features WHERE posttypeid = {} AND id BETWEEN 4 AND 78300003")

_RUN = """SELECT count(*) AS processed, count(*) FILTER (NOT ({0})) AS stored, count(*) FILTER ({0}) AS rejected,
        count(*) FILTER (NOT ({0})) AS in_table, count(*) FILTER ({0}) AS in_rejects FROM {1}"""

ORACLE = {
    "preview_lines": f"WITH {COMMENTS_SQL} SELECT {_COMMENT_LINE} AS line FROM v_comments "
                     'ORDER BY CAST("Id" AS BIGINT) LIMIT 40',
    "preview_empty_parts": f"WITH {COMMENTS_SQL} SELECT {_COMMENT_LINE} AS line FROM v_comments "
                           'ORDER BY CAST("Id" AS BIGINT) LIMIT 40',
    "line_count": "SELECT count(*) AS lines, least(count(*), 41) AS lines_seen FROM conversations",
    "xml_roundtrip": f"WITH {POSTS_SQL} SELECT * FROM v_posts",
    "attr_projection_defaults": f"""WITH {USERS_SQL} SELECT "Id", "Reputation", "DisplayName", "AccountId",
        coalesce("Location", '') AS "Location", coalesce("AboutMe", '') AS "AboutMe",
        coalesce("WebsiteUrl", '') AS "WebsiteUrl" FROM v_users""",
    "typed_cast_reject": f"""WITH {_BAD} SELECT "Id" AS raw_id, TRY_CAST("Id" AS BIGINT) AS "Id",
        TRY_CAST("PostTypeId" AS TINYINT) AS "PostTypeId", TRY_CAST("Score" AS INTEGER) AS "Score",
        TRY_CAST("CreationDate" AS TIMESTAMP) AS "CreationDate", error_reason FROM judged""",
    "rejected_rows": f"""WITH {_BAD} SELECT "Id", "PostTypeId", "Score", "CreationDate", "Title", error_reason
        FROM judged WHERE error_reason IS NOT NULL""",
    "dead_letter_summary": f"""WITH {_BAD},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY error_reason ORDER BY "Id") AS n
                   FROM judged WHERE error_reason IS NOT NULL)
        SELECT error_reason, count(*) AS rows, CAST(least(count(*), 50) AS INTEGER) AS shown,
               string_agg("Id", ',' ORDER BY "Id") FILTER (n <= 50) AS example_ids FROM ranked GROUP BY error_reason""",
    "run_counters": f"""WITH {_BAD} SELECT count(*) AS processed,
        count(*) FILTER (error_reason IS NULL) AS stored,
        count(*) FILTER (error_reason IS NOT NULL) AS rejected FROM judged""",
    "html_unescape": f"SELECT page_id, {_decode('html')} AS text FROM pages",
    "html_strip": f"SELECT page_id, {_strip_tags(_decode('html'))} AS text FROM pages",
    "normalize_text": f"SELECT doc_id, {_normalize('text')} AS text FROM documents",
    "code_blocks": f"""WITH {POSTS_SQL} SELECT "Id", CAST(len({_BLOCKS}) AS INTEGER) AS code_block_count,
        coalesce({_LINES}, 0) AS code_total_lines, {_FIRST_BLOCK} AS first_block FROM v_posts""",
    "links_images": f"SELECT page_id, {_links('html')} FROM pages",
    "links_images_posts": f"""WITH {POSTS_SQL} SELECT "Id", {_links('"Body"')} FROM v_posts""",
    "tokens": f"SELECT conv_id, turn, array_to_string({_words('text')}, ' ') AS tokens FROM conversations",
    "text_stats": f"""WITH worded AS (SELECT doc_id, text, {_words('text')} AS words FROM documents),
        counted AS (SELECT doc_id, CAST(len(words) AS INTEGER) AS word_count,
                    greatest(1, {_count('text', '[.!?]+')}) AS sentence_count,
                    CAST(coalesce({_SYLLABLES}, 0) AS INTEGER) AS syllable_count FROM worded)
        SELECT *, {_flesch('word_count', 'sentence_count', 'syllable_count')} AS flesch_reading FROM counted""",
    "stored_text": f"WITH {_FEATURES} SELECT id, title, body FROM features",
    "stored_text_full": f"""WITH {_TEXTS} SELECT CAST("Id" AS BIGINT) AS id, replace(title_text, '\\', '\\\\') AS title,
        replace("Body", '\\', '\\\\') AS body FROM scored""",
    "tags_entropy": f"""WITH {POSTS_SQL}, tagged AS (SELECT "Id", {_TAGS} AS list FROM v_posts)
        SELECT "Id", array_to_string(list, '|') AS tags, CAST(len(list) AS INTEGER) AS tagcount,
               {_entropy('list')} AS tag_entropy FROM tagged""",
    "tag_counts": f"""WITH {POSTS_SQL}, tagged AS (SELECT "Id", unnest({_TAGS}) AS tag FROM v_posts)
        SELECT "Id", tag, count(*) AS n FROM tagged GROUP BY "Id", tag""",
    "code_language": f"""WITH {POSTS_SQL} SELECT "Id", {_language(_FIRST_BLOCK)} AS language FROM v_posts""",
    "guessed_lang": f"WITH {POSTS_SQL} SELECT \"Id\", coalesce(lower(({_TAGS})[1]), {_language(_FIRST_BLOCK)}) "
                    "AS guessed_lang FROM v_posts",
    "keyword_overlap": f"WITH {_TEXTS} SELECT \"Id\", " + ", ".join(
        f"CAST({_overlap(w)} AS INTEGER) AS {t}" for t, w in rules.TOPIC_KEYWORDS.items()) + " FROM scored",
    "topic_scores": f"WITH {_TEXTS} SELECT \"Id\", {', '.join(_TOPICS)} FROM scored",
    "topic_class": f"WITH {_TEXTS} SELECT \"Id\", {_CATEGORY} AS category, {_SHARE} AS confidence FROM scored",
    "posts_features": f"WITH {_FEATURES} SELECT * FROM features",
    "comment_class": f"WITH {COMMENTS_SQL} SELECT \"Id\", {_COMMENT_CLASS} AS \"CommentClass\" FROM v_comments",
    "comments_processed": f"WITH {_PROCESSED_COMMENTS} SELECT * FROM processed",
    "user_type": f"WITH {_USERS} SELECT CAST(\"Id\" AS VARCHAR) AS \"Id\", \"UserType\" FROM processed",
    "user_degree": f"WITH {_USERS} SELECT CAST(\"Id\" AS VARCHAR) AS \"Id\", \"Degree\" FROM processed",
    "user_country": f"WITH {_USERS} SELECT \"Id\", \"Country\" AS country, \"Continent\" AS continent FROM placed",
    "user_continent": f"WITH {_USERS} SELECT \"Id\", \"Continent\" AS continent FROM placed",
    "continent_counts": f"WITH {_USERS} SELECT \"Continent\", \"Country\", count(*) AS users FROM processed GROUP BY ALL",
    "users_processed": f"WITH {_USERS} SELECT * FROM processed",
    "split_questions": f"WITH {_FEATURES} {_SPLIT.format(1)}",
    "split_answers": f"WITH {_FEATURES} {_SPLIT.format(2)}",
    "split_all": f"WITH {_FEATURES} SELECT id, posttypeid, score, category FROM features WHERE posttypeid IN (1, 2)",
    "split_ranges": """SELECT doc_id AS id, CAST(doc_id % 3 + 1 AS TINYINT) AS posttypeid,
        4 + (doc_id - 4) // 100 * 100 AS range_start FROM documents
        WHERE doc_id % 3 < 2 AND doc_id BETWEEN 4 AND 78300003""",
    "split_tables": f"""WITH {_FEATURES} SELECT id, posttypeid, tags, tagcount, word_count, category, confidence
        FROM features WHERE posttypeid IN (1, 2) AND id BETWEEN 4 AND 78300003""",
    "append_comments": f"WITH {_PROCESSED_COMMENTS} SELECT \"Id\", \"CommentClass\", 2 * count(*) AS copies "
                       "FROM processed GROUP BY ALL",
    "bounded_batches": "SELECT count(*) AS rows, true AS bounded, true AS several FROM conversations",
    "upsert_latest": """SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
        WHERE n = 1""",
    "upsert_posts": f"""WITH {_FEATURES} SELECT id, posttypeid,
        CAST(CASE WHEN posttypeid = 1 THEN score + 1000 ELSE score END AS INTEGER) AS score, viewcount,
        CASE WHEN posttypeid = 1 THEN 'edited' ELSE body END AS body, word_count FROM features""",
    "stream_append_comments": f"WITH {_PROCESSED_COMMENTS} SELECT * FROM processed",
    "stream_upsert_posts": f"WITH {_FEATURES} SELECT * FROM features",
    "stream_rejects": f'WITH {_BAD} SELECT "Id", error_reason FROM judged',
    "run_posts": f"WITH {_BAD} {_RUN.format('error_reason IS NOT NULL', 'judged')}",
    "run_users": _RUN.format("c_custkey % 10 = 7", "customer"),
    "run_comments": _RUN.format("(conv_id * 1000 + turn) % 10 = 2", "conversations"),
    "xml_multiline": f"WITH {POSTS_SQL} SELECT * FROM v_posts",
    "run_posts_twice": f"WITH {_BAD} {_RUN.format('error_reason IS NOT NULL', 'judged')}",
    "run_users_twice": _RUN.format("c_custkey % 10 = 7", "customer"),
    "replay_rejects": f"""WITH {BAD_POSTS_SQL},
        fixed AS (SELECT * REPLACE (replace("Id", 'x', '') AS "Id", CASE "Score" WHEN 'abc' THEN '-1' ELSE "Score" END AS "Score")
                  FROM v_bad_posts)
        SELECT "Id", "Score", {_REASON} AS error_reason FROM fixed""",
    "upsert_vacuum": f"""WITH {_FEATURES} SELECT id, posttypeid,
        CAST(CASE WHEN posttypeid = 1 THEN score + 1000 ELSE score END AS INTEGER) AS score, viewcount,
        CASE WHEN posttypeid = 1 THEN 'edited' ELSE body END AS body, word_count, true AS cleaned FROM features""",
    "create_if_absent": f"WITH {_FEATURES} SELECT id, posttypeid, score FROM features",
    "split_changes": f"""WITH {_FEATURES} SELECT id, posttypeid,
        CAST(CASE WHEN posttypeid = 1 THEN score + 1000 ELSE score END AS INTEGER) AS score, category
        FROM features WHERE posttypeid IN (1, 2)""",
    "sql_functions": f"""WITH {POSTS_SQL}, tagged AS (SELECT *, {_TAGS} AS list FROM v_posts)
        SELECT "Id", array_to_string(list, '|') AS tags, {_count('"Body"', r"(?i)<a\s+href=")} AS external_link_count,
               CAST(regexp_matches("Body", '(?i)<img\\s+src=') AS INTEGER) AS has_image,
               CAST(len({_BLOCKS}) AS INTEGER) AS code_block_count, {_FIRST_BLOCK} AS first_block FROM tagged""",
    "sql_classifiers": f"""WITH {_USERS}, {COMMENTS_SQL}
        SELECT 'comment' AS kind, "Id", {_COMMENT_CLASS} AS class FROM v_comments
        UNION ALL SELECT 'type', CAST("Id" AS VARCHAR), "UserType" FROM processed
        UNION ALL SELECT 'degree', CAST("Id" AS VARCHAR), "Degree" FROM processed""",
}
ORACLE["sql_text_stats"] = ORACLE["text_stats"]
ORACLE["sql_tag_counts"] = ORACLE["tag_counts"]
