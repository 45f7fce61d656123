"""Schemas of the dumps (all strings), their typed columns, and the output tables."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Attribute -> target type, in dump order of use.
POSTS = {
    "Id": "bigint", "PostTypeId": "tinyint", "ParentId": "bigint", "AcceptedAnswerId": "bigint",
    "CreationDate": "timestamp_ntz", "Score": "int", "ViewCount": "int", "OwnerUserId": "bigint",
    "LastEditorUserId": "bigint", "LastEditDate": "timestamp_ntz", "LastActivityDate": "timestamp_ntz",
    "Tags": "string", "Title": "string", "Body": "string",
}
USERS = {
    "Id": "bigint", "Reputation": "int", "DisplayName": "string", "Location": "string", "AboutMe": "string",
    "WebsiteUrl": "string", "AccountId": "bigint", "CreationDate": "timestamp_ntz",
    "LastAccessDate": "timestamp_ntz",
}
COMMENTS = {
    "Id": "bigint", "PostId": "bigint", "Score": "int", "Text": "string", "CreationDate": "timestamp_ntz",
    "UserId": "bigint",
}
VOTES = {"Id": "bigint", "PostId": "bigint", "VoteTypeId": "tinyint", "CreationDate": "timestamp_ntz"}


def raw_schema(columns: dict[str, str]) -> T.StructType:
    """All attributes as optional strings, plus the text of a row that does not parse."""
    names = [*columns, CORRUPT]
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "tinyint": T.ByteType(), "double": T.DoubleType(),
    "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _table(columns: str) -> T.StructType:
    """Schema of "name type, ..."; needs no session, unlike Spark's own reader of such text."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


POSTS_FEATURES = _table("""
    id bigint, posttypeid tinyint, parentid bigint, acceptedanswerid bigint, creationdate timestamp_ntz,
    score int, viewcount int, owneruserid bigint, lasteditoruserid bigint, lasteditdate timestamp_ntz,
    lastactivitydate timestamp_ntz, tags string, tagcount int, tag_entropy double, title string, body string,
    word_count int, sentence_count int, flesch_reading double, code_block_count int, code_total_lines int,
    has_link int, external_link_count int, has_image int, guessed_lang string, category string,
    confidence double""")

# Questions and answers keep everything but the body.
SPLIT_COLUMNS = [f.name for f in POSTS_FEATURES if f.name != "body"]

USERS_PROCESSED = _table("""
    Id bigint, Reputation int, DisplayName string, Location string, AboutMe string, UserType string,
    Degree string, Country string, Continent string, AccountId bigint, CreationDate timestamp_ntz,
    LastAccessDate timestamp_ntz""")

COMMENTS_PROCESSED = _table("""
    Id bigint, PostId bigint, Score int, Text string, CreationDate timestamp_ntz, UserId bigint,
    CommentClass string""")

# Longest text a column of the output may hold.
MAX_LENGTHS = {"tags": 1000, "guessed_lang": 50}
STORED_TEXT_LENGTH = 2000
