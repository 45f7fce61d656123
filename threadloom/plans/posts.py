"""Posts: dump rows to the 27-column feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import tags as tg
from threadloom.functions import text as tx
from threadloom.operators import classify
from threadloom.operators.validate import reject_reason, rejected, typed
from threadloom.plans.load import replay, run_dump
from threadloom.schemas import MAX_LENGTHS, POSTS, POSTS_FEATURES, STORED_TEXT_LENGTH

_IDS_AND_DATES = [
    "Id", "PostTypeId", "ParentId", "AcceptedAnswerId", "CreationDate", "Score", "ViewCount", "OwnerUserId",
    "LastEditorUserId", "LastEditDate", "LastActivityDate",
]


def post_reject_reason() -> Column:
    """Typing errors and tag fields too long to store.

    A guessed language comes from the first tag or from a short fixed list, so its
    length is known from the tags alone and no feature is computed for the check.
    """
    tag_list = tg.tags_to_list(F.col("Tags"))
    return reject_reason(POSTS, lengths=[
        ("tags", tg.join_tags(tag_list), MAX_LENGTHS["tags"]),
        ("guessed_lang", F.get(tag_list, F.lit(0)), MAX_LENGTHS["guessed_lang"])])


def posts_features(raw: DataFrame, escape_backslashes: bool = True, stored_length: int | None = STORED_TEXT_LENGTH,
                   topic_patterns=None, topic_keywords=None,
                   language_hints=None) -> DataFrame:
    """Features of the valid rows of a raw posts DataFrame; the others are in :func:`posts_rejected`.

    Title and body are stored up to ``stored_length`` characters, or whole if it is None; all features are
    those of the whole text.
    """
    texts = post_texts(raw.where(post_reject_reason().isNull()), topic_patterns, topic_keywords)
    scores = post_scores(topic_patterns, topic_keywords)
    names = list(scores)
    scored = texts.select("*", *[scores[n].alias(f"_score_{n}") for n in names])
    category, confidence = classify.topic_class({n: F.col(f"_score_{n}") for n in names})

    def stored(text: str) -> Column:
        # Doubling only lengthens, so what is stored comes from as many characters at most.
        def cut(c: Column) -> Column:
            return c if stored_length is None else F.substring(c, 1, stored_length)

        head = cut(F.col(text))
        return cut(F.replace(head, F.lit("\\"), F.lit("\\\\"))) if escape_backslashes else head

    words = F.size("_tokens")
    sentences = tx.sentence_count(F.col("_text"))
    links = tx.link_count(F.col("_body"))
    values = {c.lower(): typed(POSTS, c) for c in _IDS_AND_DATES} | {
        "tags": tg.join_tags(F.col("_tags")),
        "tagcount": F.size("_tags"),
        "tag_entropy": tg.tag_entropy(F.col("_tags")),
        "title": stored("_title"),
        "body": stored("_body"),
        "word_count": words,
        "sentence_count": sentences,
        "flesch_reading": tx.flesch_reading_ease(words, sentences, tx.syllable_count_of(F.col("_fold"), F.col("_tokens"))),
        "code_block_count": F.size("_blocks"),
        "code_total_lines": tx.non_blank_lines(F.col("_blocks")),
        "has_link": (links > 0).cast("int"),
        "external_link_count": links,
        "has_image": tx.has_image(F.col("_body")).cast("int"),
        "guessed_lang": classify.guessed_language(F.col("_tags"), F.col("_blocks"), language_hints),
        "category": category,
        "confidence": confidence,
    }
    return scored.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in POSTS_FEATURES])


def post_texts(raw: DataFrame, topic_patterns=None, topic_keywords=None) -> DataFrame:
    """Raw rows plus the texts every feature starts from, each computed once.

    ``_title`` decoded; ``_body`` raw; ``_text`` title and stripped body; ``_fold`` its
    lower case; ``_tokens`` its words; ``_words``, ``_fold_words`` those that can count
    for a topic; ``_blocks`` code blocks; ``_tags`` tag list.
    """
    def topic_words(tokens: Column) -> Column:
        return classify.topic_words(tokens, topic_patterns, topic_keywords)

    return (
        raw.select(
            "*",
            F.coalesce("Body", F.lit("")).alias("_body"),
            # Title and body through one expression: its entity tables are in the plan once.
            F.transform(F.array(*[F.coalesce(c, F.lit("")) for c in ("Title", "Body")]), tx.unescape).alias("_decoded"),
            tg.tags_to_list(F.col("Tags")).alias("_tags"))
        .select(
            "*",
            F.col("_decoded")[0].alias("_title"),
            F.concat(F.col("_decoded")[0], F.lit(" "), tx.strip_tags(F.col("_decoded")[1])).alias("_text"),
            tx.code_blocks(F.col("_body")).alias("_blocks"))
        .select("*", F.lower("_text").alias("_lower"))
        .select("*", tx.fold(F.col("_lower")).alias("_fold"), tx.words_of(F.col("_lower")).alias("_tokens"))
        .select("*", topic_words(F.col("_tokens")).alias("_words"))
        .select("*", F.when(F.col("_fold") == F.col("_lower"), F.col("_words"))
                .otherwise(topic_words(tx.words_of(F.col("_fold")))).alias("_fold_words")))


def post_scores(topic_patterns=None, topic_keywords=None) -> dict[str, Column]:
    return classify.topic_scores(
        F.col("_fold"), F.col("_fold_words"), F.col("_words"), topic_patterns, topic_keywords)


def posts_rejected(raw: DataFrame) -> DataFrame:
    return rejected(raw, post_reject_reason())


def run_posts(spark: SparkSession, src, dst: str, rejects: str | None = None, reader: str = "text", run: str | None = None,
              **options) -> dict:
    """Dump to feature table by upsert, read and parsed once; rejected rows as JSON in ``rejects``, by default beside
    the table. ``reader``: "text" for a row per line, "xml" for other layouts. The rejects of a dump that was loaded
    already are not added again, unless it is named as another ``run``. Returns the run counters with the elapsed
    seconds."""
    return run_dump(spark, src, reader, run, POSTS, **_plan(dst, rejects, options))


def replay_posts(spark: SparkSession, corrected: DataFrame, dst: str, rejects: str | None = None, run: str | None = None, **options) -> dict:
    """Corrected rejects (see ``read_rejects``) to the same tables; their old entries are resolved."""
    return replay(spark, corrected, POSTS, run=run, **_plan(dst, rejects, options))


def _plan(dst: str, rejects: str | None, options: dict) -> dict:
    return {"reason": post_reject_reason(), "transform": lambda good: posts_features(good, **options), "schema": POSTS_FEATURES,
            "dst": dst, "rejects": rejects or f"{dst}-rejected", "order": ["lastactivitydate"]}
