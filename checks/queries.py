"""One query per operator, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import shapes
from threadloom.functions import sql as sql_functions_of
from threadloom.functions import tags as tg
from threadloom.functions import text as tx
from threadloom.operators import classify, places, split, validate
from threadloom.plans import comments as pc
from threadloom.plans import posts as pp
from threadloom.plans import users as pu
from threadloom.schemas import COMMENTS, CORRUPT, POSTS, POSTS_FEATURES, USERS
from threadloom.session import work_folder
from threadloom.sinks import dead_letters, versions
from threadloom.sinks import tables as sinks
from threadloom.sources import dump
from threadloom.sources.tables import read_comments, read_features, read_users
from threadloom.streaming import ingest

PLACES = places.place_table(shapes.CITIES)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def raw(df: DataFrame) -> DataFrame:
    """Shaped rows as a scan gives them."""
    return df.withColumn(CORRUPT, F.lit(None).cast("string"))


def raw_posts(spark, sf) -> DataFrame:
    return raw(shapes.posts(spark, sf))


def raw_users(spark, sf) -> DataFrame:
    return raw(shapes.users(spark, sf))


def raw_comments(spark, sf) -> DataFrame:
    return raw(shapes.comments(spark, sf))


def written_dump(spark, df: DataFrame, name: str) -> str:
    path = work_folder(spark, name)
    dump.to_dump_lines(df).write.text(path)
    return path


# ---- sources ------------------------------------------------------------------------

@query
def preview_lines(spark, sf):
    path = work_folder(spark, "preview")
    rows = shapes.comments(spark, sf)
    # Sorted by id, so that the first parts of the dump have the lowest ids.
    dump.to_dump_lines(rows.orderBy(F.col("Id").cast("bigint"))).write.text(path)
    return dump.preview(spark, path, 40)


@query
def preview_empty_parts(spark, sf):
    """More empty parts than lines asked for, before and after the parts that have some."""
    path = work_folder(spark, "preview-empty")
    empty = spark.createDataFrame([], "value string")
    for _ in range(45):
        empty.write.mode("append").text(path)
    rows = shapes.comments(spark, sf).orderBy(F.col("Id").cast("bigint"))
    dump.to_dump_lines(rows).write.mode("append").text(path)  # sorted parts, in name order
    return dump.preview(spark, path, 40)


@query
def line_count(spark, sf):
    return dump.line_count(spark, written_dump(spark, shapes.comments(spark, sf), "lines"), 40)


@query
def xml_roundtrip(spark, sf):
    path = written_dump(spark, shapes.posts(spark, sf), "posts")
    return dump.scan_dump(spark, path, POSTS).drop(CORRUPT)


@query
def xml_multiline(spark, sf):
    """Every attribute on a line of its own, by the reader that splits such files too."""
    path = work_folder(spark, "multiline")
    dump.to_dump_lines(shapes.posts(spark, sf), separator="\n    ").write.text(path)
    return dump.scan_dump_elements(spark, path, POSTS).drop(CORRUPT)


@query
def attr_projection_defaults(spark, sf):
    rows = dump.scan_dump(spark, written_dump(spark, shapes.users(spark, sf), "users"), USERS)
    return rows.select("Id", "Reputation", "DisplayName", "AccountId",
                       *[F.coalesce(c, F.lit("")).alias(c) for c in ("Location", "AboutMe", "WebsiteUrl")])


# ---- typing and rejection -------------------------------------------------------------

@query
def typed_cast_reject(spark, sf):
    rows = raw(shapes.bad_posts(spark, sf))
    return rows.select(F.col("Id").alias("raw_id"), *[validate.typed(POSTS, c).alias(c) for c in
                       ("Id", "PostTypeId", "Score", "CreationDate")], pp.post_reject_reason().alias("error_reason"))


@query
def rejected_rows(spark, sf):
    return pp.posts_rejected(raw(shapes.bad_posts(spark, sf))).select(
        "Id", "PostTypeId", "Score", "CreationDate", "Title", "error_reason")


@query
def dead_letter_summary(spark, sf):
    path = work_folder(spark, "rejects")
    rejects = pp.posts_rejected(raw(shapes.bad_posts(spark, sf)))
    dead_letters.publish_rejects(spark, path, "one", dead_letters.write_rejects(spark, rejects, POSTS, path))
    summary = validate.error_summary(dead_letters.read_rejects(spark, path, POSTS))
    ids = F.array_join(F.transform("examples", lambda e: F.get_json_object(e, "$.Id")), ",")
    return summary.select("error_reason", "rows", F.size("examples").alias("shown"), ids.alias("example_ids"))


@query
def run_counters(spark, sf):
    return validate.run_counters(raw(shapes.bad_posts(spark, sf)), pp.post_reject_reason())


# ---- text -----------------------------------------------------------------------------

@query
def html_unescape(spark, sf):
    return shapes.table(spark, sf, "pages").select("page_id", tx.unescape(F.col("html")).alias("text"))


@query
def html_strip(spark, sf):
    return shapes.table(spark, sf, "pages").select("page_id", tx.html_to_text(F.col("html")).alias("text"))


@query
def normalize_text(spark, sf):
    return shapes.table(spark, sf, "documents").select("doc_id", tx.normalize_text(F.col("text")).alias("text"))


@query
def code_blocks(spark, sf):
    blocks = tx.code_blocks(F.col("Body"))
    return (shapes.posts(spark, sf).select("Id", blocks.alias("blocks"))
            .select("Id", F.size("blocks").alias("code_block_count"),
                    tx.non_blank_lines(F.col("blocks")).alias("code_total_lines"),
                    F.coalesce(F.get("blocks", F.lit(0)), F.lit("")).alias("first_block")))


def _links(key: Column, body: Column) -> list[Column]:
    return [key, (tx.link_count(body) > 0).cast("int").alias("has_link"), tx.link_count(body).alias("external_link_count"),
            tx.has_image(body).cast("int").alias("has_image")]


@query
def links_images(spark, sf):
    return shapes.table(spark, sf, "pages").select(*_links(F.col("page_id"), F.col("html")))


@query
def links_images_posts(spark, sf):
    return shapes.posts(spark, sf).select(*_links(F.col("Id"), F.col("Body")))


@query
def tokens(spark, sf):
    return shapes.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(tx.tokenize(F.col("text")), " ").alias("tokens"))


@query
def text_stats(spark, sf):
    docs = shapes.table(spark, sf, "documents")
    worded = docs.select("doc_id", "text", tx.tokenize(F.col("text")).alias("tokens"))
    counted = worded.select(
        "doc_id", F.size("tokens").alias("word_count"),
        tx.sentence_count(F.col("text")).alias("sentence_count"),
        tx.syllable_count(F.col("tokens")).alias("syllable_count"))
    return counted.select("*", tx.flesch_reading_ease(
        F.col("word_count"), F.col("sentence_count"), F.col("syllable_count")).alias("flesch_reading"))


@query
def stored_text(spark, sf):
    return pp.posts_features(raw_posts(spark, sf)).select("id", "title", "body")


@query
def stored_text_full(spark, sf):
    return pp.posts_features(raw_posts(spark, sf), stored_length=None).select("id", "title", "body")


# ---- tags and languages ---------------------------------------------------------------

@query
def tags_entropy(spark, sf):
    tagged = shapes.posts(spark, sf).select("Id", tg.tags_to_list(F.col("Tags")).alias("list"))
    return tagged.select("Id", tg.join_tags(F.col("list")).alias("tags"), F.size("list").alias("tagcount"),
                         tg.tag_entropy(F.col("list")).alias("tag_entropy"))


@query
def tag_counts(spark, sf):
    exploded = shapes.posts(spark, sf).select("Id", F.explode(tg.tags_to_list(F.col("Tags"))).alias("tag"))
    return exploded.groupBy("Id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query
def code_language(spark, sf):
    first = F.coalesce(F.get(tx.code_blocks(F.col("Body")), F.lit(0)), F.lit(""))
    return shapes.posts(spark, sf).select("Id", first.alias("code")).select(
        "Id", classify.code_language(F.col("code")).alias("language"))


@query
def guessed_lang(spark, sf):
    parts = shapes.posts(spark, sf).select(
        "Id", tg.tags_to_list(F.col("Tags")).alias("tags"), tx.code_blocks(F.col("Body")).alias("blocks"))
    return parts.select("Id", classify.guessed_language(F.col("tags"), F.col("blocks")).alias("guessed_lang"))


# ---- topics ---------------------------------------------------------------------------

def _scored(spark, sf) -> tuple[DataFrame, list[str]]:
    scores = pp.post_scores()
    texts = pp.post_texts(raw_posts(spark, sf))
    return texts.select("Id", *[s.alias(n) for n, s in scores.items()]), list(scores)


@query
def keyword_overlap(spark, sf):
    hits = [classify.keyword_hits(F.col("_tokens"), words).alias(topic)
            for topic, words in classify.rules.TOPIC_KEYWORDS.items()]
    return pp.post_texts(raw_posts(spark, sf)).select("Id", *hits)


@query
def topic_scores(spark, sf):
    return _scored(spark, sf)[0]


@query
def topic_class(spark, sf):
    scored, names = _scored(spark, sf)
    category, confidence = classify.topic_class({n: F.col(n) for n in names})
    return scored.select("Id", category.alias("category"), confidence.alias("confidence"))


@query
def posts_features(spark, sf):
    return pp.posts_features(raw_posts(spark, sf))


# ---- comments and users ---------------------------------------------------------------

@query
def comment_class(spark, sf):
    return shapes.comments(spark, sf).select("Id", classify.comment_class(F.col("Text")).alias("CommentClass"))


@query
def comments_processed(spark, sf):
    return pc.comments_processed(raw_comments(spark, sf))


def _bios(spark, sf) -> DataFrame:
    return shapes.users(spark, sf).select("Id", "WebsiteUrl", tx.normalize_text(F.col("AboutMe")).alias("bio"))


@query
def user_type(spark, sf):
    return _bios(spark, sf).select("Id", classify.user_type(F.col("bio"), F.col("WebsiteUrl")).alias("UserType"))


@query
def user_degree(spark, sf):
    return _bios(spark, sf).select("Id", classify.degree(F.col("bio")).alias("Degree"))


@query
def user_country(spark, sf):
    located = shapes.users(spark, sf).select("Id", places.normalized_location(F.col("Location")).alias("location"))
    return located.select("Id", F.inline(F.array(places.country_and_continent(F.col("location"), PLACES))))


@query
def user_continent(spark, sf):
    return user_country(spark, sf).select("Id", "continent")


@query
def continent_counts(spark, sf):
    return (pu.users_processed(raw_users(spark, sf), places=PLACES)
            .groupBy("Continent", "Country").agg(F.count(F.lit(1)).alias("users")))


@query
def users_processed(spark, sf):
    return pu.users_processed(raw_users(spark, sf), places=PLACES)


# ---- the same in SQL ----------------------------------------------------------------------

@query
def sql_functions(spark, sf):
    """Text functions called from SQL, over all posts."""
    sql_functions_of.register(spark, "tl_")
    return spark.sql("""
        SELECT Id, array_join(tl_tag_list(Tags), '|') AS tags, tl_link_count(Body) AS external_link_count,
               CAST(tl_has_image(Body) AS INT) AS has_image, size(tl_code_blocks(Body)) AS code_block_count,
               coalesce(try_element_at(tl_code_blocks(Body), 1), '') AS first_block FROM {posts}""", posts=shapes.posts(spark, sf))


@query
def sql_text_stats(spark, sf):
    sql_functions_of.register(spark, "tl_")
    return spark.sql("""
        SELECT *, tl_reading_ease(word_count, sentence_count, syllable_count) AS flesch_reading FROM (
          SELECT doc_id, size(tl_words(text)) AS word_count, tl_sentence_count(text) AS sentence_count,
                 tl_syllable_count(text) AS syllable_count FROM {docs})""", docs=shapes.table(spark, sf, "documents"))


@query
def sql_classifiers(spark, sf):
    """Classes of all comments and users by SQL functions."""
    sql_functions_of.register(spark, "tl_")
    return spark.sql("""
        SELECT 'comment' AS kind, Id, tl_comment_class(Text) AS class FROM {comments}
        UNION ALL SELECT 'type', Id, tl_user_type(bio, WebsiteUrl) FROM {users}
        UNION ALL SELECT 'degree', Id, tl_user_degree(bio) FROM {users}""", comments=shapes.comments(spark, sf), users=_bios(spark, sf))


@query
def sql_tag_counts(spark, sf):
    """A table function, for each post."""
    sql_functions_of.register(spark, "tl_")
    return spark.sql("SELECT Id, t.tag, t.n FROM {posts} p, LATERAL tl_tag_counts(p.Tags) t", posts=shapes.posts(spark, sf))


# ---- split, append, upsert --------------------------------------------------------------

@query
def split_questions(spark, sf):
    return split.split_posts(pp.posts_features(raw_posts(spark, sf)), split.MIN_ID, split.last_id())[0]


@query
def split_answers(spark, sf):
    return split.split_posts(pp.posts_features(raw_posts(spark, sf)), split.MIN_ID, split.last_id())[1]


@query
def split_all(spark, sf):
    """Without bounds, every post of the two types."""
    both = split.split_posts(pp.posts_features(raw_posts(spark, sf)))
    return both[0].unionByName(both[1]).select("id", "posttypeid", "score", "category")


@query
def split_ranges(spark, sf):
    features = pp.posts_features(raw_posts(spark, sf)).select("id", "posttypeid", *split.SPLIT_COLUMNS[2:])
    both = [split.with_range(p, step=100).select("id", "posttypeid", "range_start")
            for p in split.split_posts(features, split.MIN_ID, split.last_id())]
    return both[0].unionByName(both[1])


@query
def split_tables(spark, sf):
    """Feature table written, read back, and split into two tables."""
    target, questions, answers = (work_folder(spark, n) for n in ("features", "questions", "answers"))
    sinks.upsert(spark, pp.posts_features(raw_posts(spark, sf)), target, order=["lastactivitydate"])
    first, last = split.MIN_ID, split.last_id()
    split.run_split(read_features(spark, target, first, last), questions, answers, first, last)
    both = [sinks.read_appended(spark, t, split.SPLIT_SCHEMA) for t in (questions, answers)]
    return both[0].unionByName(both[1]).select("id", "posttypeid", "tags", "tagcount", "word_count", "category", "confidence")


@query
def split_changes(spark, sf):
    """Split from an upserted table, then brought up to date after every question was written again."""
    target, questions, answers = (work_folder(spark, n) for n in ("features", "questions", "answers"))
    _upsert_twice(spark, sf, target, lambda: split.split_changes(spark, target, questions, answers))
    split.split_changes(spark, target, questions, answers)
    both = [sinks.read_table(spark, t, split.SPLIT_SCHEMA) for t in (questions, answers)]
    return both[0].unionByName(both[1]).select("id", "posttypeid", "score", "category")


@query
def append_comments(spark, sf):
    """Appending twice adds the rows twice: a plain insert looks at no key."""
    target = work_folder(spark, "comments")
    rows = pc.comments_processed(raw_comments(spark, sf))
    for _ in range(2):
        sinks.append(rows, target, max_rows_per_file=5000)
    return (spark.read.parquet(target).groupBy("Id", "CommentClass").agg(F.count(F.lit(1)).alias("copies")))


@query
def bounded_batches(spark, sf):
    """Rows are written in files of at most 20, whatever the size of a task."""
    target = work_folder(spark, "batches")
    sinks.append(pc.comments_processed(raw_comments(spark, sf)), target, max_rows_per_file=20)
    files = (spark.read.parquet(target).select(F.col("_metadata.file_path").alias("file"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("n")))
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= 20).alias("bounded"), (F.count(F.lit(1)) > 1).alias("several"))


@query
def upsert_latest(spark, sf):
    events = shapes.table(spark, sf, "events")
    return sinks.latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select(
        "user_id", "event_id", "event_type", "value")


def _upsert_twice(spark, sf, target: str, between=lambda: None) -> None:
    sinks.upsert(spark, pp.posts_features(raw_posts(spark, sf)), target, order=["lastactivitydate"], step=1000)
    between()
    again = split.of_type(read_features(spark, target), split.QUESTION).withColumns(
        {"score": F.col("score") + 1000, "body": F.lit("edited")}).select(*POSTS_FEATURES.names)
    sinks.upsert(spark, again, target, order=["lastactivitydate"], step=1000)


@query
def upsert_posts(spark, sf):
    """All posts inserted, then every question written again with other values: replaced, not added."""
    target = work_folder(spark, "upsert-posts")
    _upsert_twice(spark, sf, target)
    return read_features(spark, target).select("id", "posttypeid", "score", "viewcount", "body", "word_count")


@query
def upsert_vacuum(spark, sf):
    """The same table after the folders that only its first version names are removed."""
    target = work_folder(spark, "vacuum")
    _upsert_twice(spark, sf, target)
    removed = versions.vacuum(spark, target, keep=1, min_age=0)
    return read_features(spark, target).select(
        "id", "posttypeid", "score", "viewcount", "body", "word_count", F.lit(len(removed) > 0).alias("cleaned"))


@query
def create_if_absent(spark, sf):
    """A table created empty, loaded, and created again: its rows stay."""
    target = work_folder(spark, "created")
    sinks.ensure_table(spark, target, POSTS_FEATURES)
    pp.run_posts(spark, written_dump(spark, shapes.posts(spark, sf), "created-dump"), target)
    sinks.ensure_table(spark, target, POSTS_FEATURES)
    return read_features(spark, target).select("id", "posttypeid", "score")


# ---- streaming --------------------------------------------------------------------------

@query
def stream_append_comments(spark, sf):
    src = written_dump(spark, shapes.comments(spark, sf), "stream-comments")
    target, state = work_folder(spark, "out"), work_folder(spark, "state")
    ingest.stream_comments(spark, src, target, state).awaitTermination()
    return spark.read.parquet(target).drop(ingest.BATCH)


@query
def stream_rejects(spark, sf):
    """Of a stream with bad rows, what is stored and what is rejected make up the input."""
    src = written_dump(spark, shapes.bad_posts(spark, sf), "stream-bad-posts")
    target, rejects, state = (work_folder(spark, n) for n in ("out", "rejects", "state"))
    ingest.stream_posts(spark, src, target, state, step=1000, rejects=rejects).awaitTermination()
    bad = spark.read.schema("Id string, error_reason string").json(rejects)
    return read_features(spark, target).select(F.col("id").cast("string").alias("Id"), F.lit(None).cast("string").alias(
        "error_reason")).unionByName(bad.select("Id", "error_reason"))


# ---- whole runs -------------------------------------------------------------------------

def _counters(spark, counters: dict, stored: DataFrame, rejects: DataFrame) -> DataFrame:
    """The run's counters and what is in the tables it left."""
    seen = stored.agg(F.count(F.lit(1)).alias("in_table")).crossJoin(  # one row each
        rejects.agg(F.count("error_reason").alias("in_rejects")))
    return seen.select(*[F.lit(counters[n]).cast("bigint").alias(n) for n in ("processed", "stored", "rejected")], "*")


@query
def run_posts(spark, sf):
    src, target = written_dump(spark, shapes.bad_posts(spark, sf), "run-posts"), work_folder(spark, "posts")
    counters = pp.run_posts(spark, src, target)
    return _counters(spark, counters, read_features(spark, target), dead_letters.read_rejects(spark, f"{target}-rejected", POSTS))


@query
def run_posts_twice(spark, sf):
    """The same dump loaded again: neither rows nor rejects are doubled."""
    src, target = written_dump(spark, shapes.bad_posts(spark, sf), "run-twice"), work_folder(spark, "posts")
    counters = [pp.run_posts(spark, src, target) for _ in range(2)][1]
    rejects = sinks.read_appended(spark, f"{target}-rejected", dead_letters.reject_schema(POSTS), "json")
    return _counters(spark, counters, read_features(spark, target), rejects)


@query
def replay_rejects(spark, sf):
    """Rejects corrected as far as Id and Score go and loaded again: what is stored then, and what still waits."""
    src, target = written_dump(spark, shapes.bad_posts(spark, sf), "run-replay"), work_folder(spark, "posts")
    pp.run_posts(spark, src, target)
    corrected = dead_letters.read_rejects(spark, f"{target}-rejected", POSTS).withColumns({
        "Id": F.regexp_replace("Id", "^x", ""), "Score": F.when(F.col("Score") == "abc", "-1").otherwise(F.col("Score"))})
    pp.replay_posts(spark, corrected, target)
    waiting = dead_letters.read_rejects(spark, f"{target}-rejected", POSTS)
    stored = read_features(spark, target).select(F.col("id").cast("string").alias("Id"), F.col("score").cast("string").alias("Score"),
                                                 F.lit(None).cast("string").alias("error_reason"))
    return stored.unionByName(waiting.select("Id", "Score", "error_reason"))


@query
def run_users(spark, sf):
    rows = shapes.users(spark, sf).withColumn("Reputation", F.when(F.col("Id").endswith("7"), "many").otherwise(F.col("Reputation")))
    src, target = written_dump(spark, rows, "run-users"), work_folder(spark, "users")
    counters = pu.run_users(spark, src, target, places=PLACES)
    return _counters(spark, counters, read_users(spark, target), dead_letters.read_rejects(spark, f"{target}-rejected", USERS))


@query
def run_users_twice(spark, sf):
    """Appended once, however often the dump is loaded."""
    rows = shapes.users(spark, sf).withColumn("Reputation", F.when(F.col("Id").endswith("7"), "many").otherwise(F.col("Reputation")))
    src, target = written_dump(spark, rows, "run-users-twice"), work_folder(spark, "users")
    counters = [pu.run_users(spark, src, target, places=PLACES) for _ in range(2)][1]
    rejects = sinks.read_appended(spark, f"{target}-rejected", dead_letters.reject_schema(USERS), "json")
    return _counters(spark, counters, read_users(spark, target), rejects)


@query
def run_comments(spark, sf):
    rows = shapes.comments(spark, sf).withColumn("Score", F.when(F.col("Id").endswith("2"), "high").otherwise(F.col("Score")))
    src, target = written_dump(spark, rows, "run-comments"), work_folder(spark, "comments")
    counters = pc.run_comments(spark, src, target)
    return _counters(spark, counters, read_comments(spark, target), dead_letters.read_rejects(spark, f"{target}-rejected", COMMENTS))


@query
def stream_upsert_posts(spark, sf):
    src = written_dump(spark, shapes.posts(spark, sf), "stream-posts")
    target, state = work_folder(spark, "out"), work_folder(spark, "state")
    ingest.stream_posts(spark, src, target, state, step=1000).awaitTermination()
    return read_features(spark, target)
