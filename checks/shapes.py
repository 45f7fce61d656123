"""Dump-shaped rows from the given tables, in Spark and in SQL.

The tables have the volume but not the vocabulary, so every row of a table gets a
phrase of a fixed list, chosen by its id; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


COMMENT_PHRASES = [
    "This is wrong", "let me debug this", "cannot reproduce", "wrongly put", "why is that", "really?",
    "you should retry", "conversion done", "crashes on start", "error message shown", "duplicate of another",
    "please edit the formatting", "", "instead you canvas the version", "instead you can retry",
]
TITLE_PHRASES = [
    "Null pointer exception crash", "Which table schema is more efficient?", "What is the theory, explain why",
    "Docker install config environment service", "deprecated since version 2, python 3", "error and why",
    "hello world", "best practice recommended", "C:\\temp path fails", "", "how does it do",
]
TAG_LISTS = ["|python|error|", "<c#><.net>", "|Java|", "", "|a|a|b|", None, "|sql||join|"]
_DEF_BLOCK = "<pre><code>def f(self):\n\n  import x</code></pre>"
BODY_SNIPPETS = [
    _DEF_BLOCK, "<PRE><CODE>select a from b</CODE></PRE>", '<pre class="x"><code>var y</code></pre>',
    '<a href="/q">q</a> <a  HREF="z">', '<img src="i.png">', '<a class="k" href="n">',
    "<abbr>kept</abbr> <b>gone</b>", "5 &lt;div&gt; 6 &amp;amp; 7", "",
    "<pre><code>public static void x() extends</code></pre>", "<pre><code>let y = z => 1;</code></pre>",
    "<pre><code>using System; namespace x</code></pre>",
]
LOCATIONS = [
    "El Cerrito, CA", "Johnson City, TN, USA", "on the server farm", "Berlin, DE", "Berlin, Germany",
    "Georgia, USA", "Tbilisi, Georgia", "Tbilisi", "Georgia", "Atlanta", "Bucharest, Romania", "Lagos, Nigeria",
    "Mogadishu, Somalia", "Toronto, Canada", "Toronto, Ontario", "Caracas", "Lusaka", "São Paulo", "Malé",
    "London,   UK", "Remote", None, "",
]
# Cities for the place table, besides the country names it is built from.
CITIES = {
    "brazil": ["rio", "sao paulo"], "canada": ["toronto"], "georgia (usa)": ["atlanta", "savannah"],
    "germany": ["berlin"], "maldives": ["male"], "nigeria": ["lagos"], "romania": ["bucharest"],
    "somalia": ["mogadishu"], "united kingdom": ["london"], "venezuela": ["caracas"], "zambia": ["lusaka"],
}
BIOS = [
    "i hold a phd", "dr. x", "prof. smith", "professor and student", "graduate student", "undergraduate",
    "researcher at a lab", "software engineer, consultant", "gitlab developer", "engineer at a university",
    "<p>Former Developer &amp; founder</p>", "graduated from  a University,\n prof.smith", "b.sc and more",
    "postdoc, founder", "a student", None,
]
WEBSITES = ["", "https://gitlab.com/x", "https://developer.example.org"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index % len(values) + 1).cast("int"))


def _date(key: Column, month: str) -> Column:
    """Timestamp text of a key; written digit by digit so that SQL can do the same."""
    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.lit(f"2008-{month}-"), two(key % 28 + 1), F.lit("T"), two(key % 24), F.lit(":"), two(key % 60),
                    F.lit(":00."), F.lpad((key % 1000).cast("string"), 3, "0"))


def _date_sql(key: str, month: str) -> str:
    return (f"'2008-{month}-' || lpad(CAST({key} % 28 + 1 AS VARCHAR), 2, '0') || 'T' || "
            f"lpad(CAST({key} % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST({key} % 60 AS VARCHAR), 2, '0') || "
            f"':00.' || lpad(CAST({key} % 1000 AS VARCHAR), 3, '0')")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        (conv * 1000 + turn).cast("string").alias("Id"),
        conv.cast("string").alias("PostId"),
        turn.cast("string").alias("Score"),
        F.concat(pick(COMMENT_PHRASES, conv + turn), F.lit(" "), F.col("text")).alias("Text"),
        _date(conv, "09").alias("CreationDate"),
        F.when(conv % 10 != 0, conv.cast("string")).alias("UserId"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    kind = key % 3 + 1
    snippet = pick(BODY_SNIPPETS, F.floor(key / 3))
    twice = F.when(F.floor(key / 3) % 18 == 0, F.lit(_DEF_BLOCK)).otherwise(F.lit(""))
    question = kind == 1
    return table(spark, sf_dir, "documents").select(
        key.cast("string").alias("Id"),
        kind.cast("string").alias("PostTypeId"),
        F.when(kind == 2, (key - 1).cast("string")).alias("ParentId"),
        F.when(question, (key + 1).cast("string")).alias("AcceptedAnswerId"),
        _date(key, "08").alias("CreationDate"),
        (key % 50).cast("string").alias("Score"),
        F.when(question, F.col("n_chars").cast("string")).alias("ViewCount"),
        (key % 7).cast("string").alias("OwnerUserId"),
        F.when(key % 2 == 0, (key % 5).cast("string")).alias("LastEditorUserId"),
        F.when(key % 2 == 0, _date(key, "10")).alias("LastEditDate"),
        _date(key, "11").alias("LastActivityDate"),
        F.when(question, pick(TAG_LISTS, key)).alias("Tags"),
        F.when(question, pick(TITLE_PHRASES, key)).alias("Title"),
        F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>"), snippet, twice).alias("Body"))


def bad_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of which some have values that do not fit their type."""
    key = F.col("_key")
    return posts(spark, sf_dir).select(
        "*", F.col("Id").cast("bigint").alias("_key")).withColumns({
            "Id": F.when(key % 17 == 0, F.concat(F.lit("x"), "Id")).otherwise(F.col("Id")),
            "Score": F.when(key % 19 == 0, F.lit("abc")).otherwise(F.col("Score")),
            "PostTypeId": F.when(key % 23 == 0, F.lit("300")).otherwise(F.col("PostTypeId")),
            "CreationDate": F.when(key % 29 == 0, F.lit("bad")).otherwise(F.col("CreationDate")),
        }).drop("_key")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("Id"),
        F.floor("c_acctbal").cast("string").alias("Reputation"),
        F.col("c_name").alias("DisplayName"),
        pick(LOCATIONS, key).alias("Location"),
        pick(BIOS, key).alias("AboutMe"),
        pick(WEBSITES, key).alias("WebsiteUrl"),
        F.when(key % 4 != 0, key.cast("string")).alias("AccountId"),
        _date(key, "01").alias("CreationDate"),
        _date(key, "02").alias("LastAccessDate"))


# ---- the same in SQL ----------------------------------------------------------------

def text_sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick_sql(values: list, index: str) -> str:
    return f"([{', '.join(map(text_sql, values))}])[CAST({index} % {len(values)} + 1 AS BIGINT)]"


COMMENTS_SQL = f"""
v_comments AS (
  SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS "Id", CAST(conv_id AS VARCHAR) AS "PostId",
         CAST(turn AS VARCHAR) AS "Score",
         {pick_sql(COMMENT_PHRASES, "(conv_id + turn)")} || ' ' || text AS "Text",
         {_date_sql("conv_id", "09")} AS "CreationDate",
         CASE WHEN conv_id % 10 <> 0 THEN CAST(conv_id AS VARCHAR) END AS "UserId"
  FROM conversations)"""

POSTS_SQL = f"""
v_posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS "Id", CAST(doc_id % 3 + 1 AS VARCHAR) AS "PostTypeId",
         CASE WHEN doc_id % 3 = 1 THEN CAST(doc_id - 1 AS VARCHAR) END AS "ParentId",
         CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id + 1 AS VARCHAR) END AS "AcceptedAnswerId",
         {_date_sql("doc_id", "08")} AS "CreationDate",
         CAST(doc_id % 50 AS VARCHAR) AS "Score",
         CASE WHEN doc_id % 3 = 0 THEN CAST(n_chars AS VARCHAR) END AS "ViewCount",
         CAST(doc_id % 7 AS VARCHAR) AS "OwnerUserId",
         CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 5 AS VARCHAR) END AS "LastEditorUserId",
         CASE WHEN doc_id % 2 = 0 THEN {_date_sql("doc_id", "10")} END AS "LastEditDate",
         {_date_sql("doc_id", "11")} AS "LastActivityDate",
         CASE WHEN doc_id % 3 = 0 THEN {pick_sql(TAG_LISTS, "doc_id")} END AS "Tags",
         CASE WHEN doc_id % 3 = 0 THEN {pick_sql(TITLE_PHRASES, "doc_id")} END AS "Title",
         '<p>' || text || '</p>' || {pick_sql(BODY_SNIPPETS, "(doc_id // 3)")} ||
           CASE WHEN (doc_id // 3) % 18 = 0 THEN {text_sql(_DEF_BLOCK)} ELSE '' END AS "Body"
  FROM documents)"""

BAD_POSTS_SQL = f"""{POSTS_SQL},
v_bad_posts AS (
  SELECT * REPLACE (
    CASE WHEN k % 17 = 0 THEN 'x' || "Id" ELSE "Id" END AS "Id",
    CASE WHEN k % 19 = 0 THEN 'abc' ELSE "Score" END AS "Score",
    CASE WHEN k % 23 = 0 THEN '300' ELSE "PostTypeId" END AS "PostTypeId",
    CASE WHEN k % 29 = 0 THEN 'bad' ELSE "CreationDate" END AS "CreationDate")
  FROM (SELECT *, CAST("Id" AS BIGINT) AS k FROM v_posts))"""

USERS_SQL = f"""
v_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "Id", CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS "Reputation",
         c_name AS "DisplayName", {pick_sql(LOCATIONS, "c_custkey")} AS "Location",
         {pick_sql(BIOS, "c_custkey")} AS "AboutMe", {pick_sql(WEBSITES, "c_custkey")} AS "WebsiteUrl",
         CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS "AccountId",
         {_date_sql("c_custkey", "01")} AS "CreationDate", {_date_sql("c_custkey", "02")} AS "LastAccessDate"
  FROM customer)"""
