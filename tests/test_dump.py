import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from threadloom.operators import split, validate
from threadloom.plans import comments as pc
from threadloom.plans import posts as pp
from threadloom.plans import users as pu
from threadloom.schemas import COMMENTS, CORRUPT, POSTS, POSTS_FEATURES, SPLIT_COLUMNS, USERS, VOTES
from threadloom.session import work_folder
from threadloom.sinks import tables as sinks
from threadloom.sinks.dead_letters import read_rejects, reject_schema
from threadloom.sinks.tables import read_appended
from threadloom.sources import dump
from threadloom.sources.tables import read_comments, read_features, read_users
from threadloom.streaming import ingest

# Lines in the layout of the dumps.
POST_LINES = """\ufeff<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" CreationDate="2011-02-03T04:05:06.880" Score="6" ViewCount="62" Body="&lt;p&gt;Our kettle is a service with a queue of cups.&lt;/p&gt;&#xA;" LastActivityDate="2013-01-02T17:03:18.890" Title="Kettle &amp;amp; queue" Tags="|kettle|queue|tea|" />
  <row Id="4" PostTypeId="2" ParentId="1" CreationDate="2011-02-03T04:44:26.013" Score="3" Body="&lt;pre&gt;&lt;code&gt;select a&#xA;&#xA;from b&lt;/code&gt;&lt;/pre&gt; &lt;a href=&quot;x&quot;&gt;C:\\dir&lt;/a&gt;" LastActivityDate="2011-02-03T04:44:26.013" />
  <row Id="5" PostTypeId="1" CreationDate="2008-09-02T03:44:26.013" Score="3" Body="" Title="" />
  <row Id="6" PostTypeId="5" Body=" x/>y " />
  <row Id="x7" PostTypeId="1" Body="b" />
  <row Id="8" PostTypeId="300" Score="many" Body="b" />
  <row PostTypeId="1" Body="no id" />
  <row Id="9" PostTypeId="1" Body="a & b" />
  <row Id="10" PostTypeId="1" /><row Id="11" PostTypeId="2" />
  <row Id="12" PostTypeId="1" Tags="|{long}|" />
</posts>
""".replace("{long}", "t" * 51)


@pytest.fixture
def dump_file(tmp_path):
    path = tmp_path / "Posts.xml"
    path.write_text(POST_LINES, encoding="utf-8")
    return str(path)


def test_scan(spark, dump_file):
    rows = {r.Id: r for r in dump.scan_dump(spark, dump_file, POSTS).collect()}
    assert set(rows) == {"1", "4", "5", "6", "x7", "8", None, "10", "11", "12"}
    assert rows["1"].Title == "Kettle &amp; queue" and rows["1"].Body.endswith("</p>\n") and rows["1"].ParentId is None
    assert rows["5"].Body == "" and rows["6"].Body == " x/>y " and rows["10"].Body is None
    corrupt = dump.scan_dump(spark, dump_file, POSTS).where(F.col(CORRUPT).isNotNull()).collect()
    assert [r[CORRUPT].strip() for r in corrupt] == ['<row Id="9" PostTypeId="1" Body="a & b" />']


def test_scan_of_other_layouts(spark, tmp_path):
    path = tmp_path / "one.xml"
    path.write_text('<votes><row Id="1" VoteTypeId="2" /><row Id="2" /></votes>')
    assert sorted(r.Id for r in dump.scan_dump(spark, str(path), VOTES).collect()) == ["1", "2"]
    path.write_text('<votes>\n<row Id="1"\n VoteTypeId="2"\n/>\n<row Id="2" />\n</votes>')
    assert sorted(r.Id for r in dump.scan_dump_elements(spark, str(path), VOTES).collect()) == ["1", "2"]


def test_missing_path_fails(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        dump.scan_dump(spark, "/nowhere/Posts.xml", POSTS)


def test_xml_is_parsed_once_per_row(spark, dump_file):
    """Filters on parsed columns must not be pushed below the parser."""
    for df in (pp.posts_features(dump.scan_dump(spark, dump_file, POSTS)),
               pc.comments_processed(dump.scan_dump(spark, dump_file, COMMENTS)),
               pu.users_processed(dump.scan_dump(spark, dump_file, USERS))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml") == 1
        assert "Exchange" not in plan and "Python" not in plan


def test_preview_and_count(spark, dump_file, tmp_path):
    lines = [line.strip() for line in POST_LINES.lstrip("\ufeff").splitlines()]
    assert [r.line for r in dump.preview(spark, dump_file, 3).collect()] == [lines[0], *lines[1:3]]
    assert tuple(dump.line_count(spark, dump_file, 3).first()) == (len(lines), 4)
    assert tuple(dump.line_count(spark, dump_file, 40).first()) == (len(lines), len(lines))
    parts = tmp_path / "parts"
    parts.mkdir()
    for i in range(4):
        (parts / f"part-{i}").write_text("".join(f"{i}{j}\n" for j in range(3)))
    for i in range(60):
        (parts / f"a-{i}").write_text("")
    assert [r.line for r in dump.preview(spark, str(parts), 7).collect()] == ["00", "01", "02", "10", "11", "12", "20"]


def test_preview_does_not_depend_on_which_task_is_first(spark, tmp_path):
    """Written on several executors, a limit over a shuffle keeps the lines that arrive first."""
    for i in range(8):
        (tmp_path / f"part-{i}").write_text("".join(f"{i}-{j}\n" for j in range(40)))
    lines = dump.preview(spark, str(tmp_path), 40)
    plan = lines.where("line <> ''")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Limit" not in plan, plan
    assert [r.line for r in lines.collect()] == [f"0-{j}" for j in range(40)]


def test_posts_features(spark, dump_file):
    raw = dump.scan_dump(spark, dump_file, POSTS)
    features = pp.posts_features(raw)
    assert features.schema.simpleString() == POSTS_FEATURES.simpleString()
    rows = {r.id: r for r in features.collect()}
    assert set(rows) == {1, 4, 5, 6, 10, 11}
    one, four, five = rows[1], rows[4], rows[5]
    assert (one.tags, one.tagcount, one.guessed_lang) == ("kettle|queue|tea", 3, "kettle")
    assert one.tag_entropy == pytest.approx(1.584962500721156)
    assert one.title == "Kettle & queue" and str(one.creationdate) == "2011-02-03 04:05:06.880000"
    assert (one.category, one.confidence, one.has_link) == ("configuration", 1.0, 0)
    assert (four.code_block_count, four.code_total_lines, four.guessed_lang) == (1, 2, "sql")
    assert (four.has_link, four.external_link_count, four.has_image) == (1, 1, 0)
    assert four.body.endswith("C:\\\\dir</a>") and four.title == "" and four.tagcount == 0
    assert (five.word_count, five.sentence_count, five.flesch_reading) == (0, 1, 0.0)
    assert (five.category, five.confidence, five.tags) == ("unknown", 0.0, "")


def test_rejected_posts(spark, dump_file):
    raw = dump.scan_dump(spark, dump_file, POSTS)
    rejects = pp.posts_rejected(raw)
    reasons = sorted((r.Id or "", r.error_reason) for r in rejects.collect())
    assert reasons == [("", "malformed row"), ("", "missing Id"), ("12", "long guessed_lang"),
                       ("8", "bad PostTypeId;bad Score"), ("x7", "bad Id")]
    assert tuple(validate.run_counters(raw, pp.post_reject_reason()).first()) == (11, 6, 5)
    summary = {r.error_reason: r for r in validate.error_summary(rejects).collect()}
    assert summary["bad Id"].rows == 1 and json.loads(summary["bad Id"].examples[0])["Id"] == "x7"


def test_error_summary_keeps_the_first_examples_of_a_frequent_reason(spark):
    rejects = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("Id"), F.when(F.col("id") < 900, "a").otherwise("b").alias("error_reason"))
    got = {r.error_reason: r for r in validate.error_summary(rejects, examples=3).collect()}
    assert (got["a"].rows, got["b"].rows) == (900, 100)
    assert [json.loads(e)["Id"] for e in got["b"].examples] == ["0900", "0901", "0902"]


def test_long_body_is_cut_after_features(spark):
    raw = spark.createDataFrame([("1", "1", "w \\" * 1000)], "Id string, PostTypeId string, Body string")
    for c in [*POSTS, CORRUPT]:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    row = pp.posts_features(raw).first()
    assert len(row.body) == 2000 and row.word_count == 1000 and row.body.startswith("w \\\\w")
    assert pp.posts_features(raw, escape_backslashes=False).first().body == ("w \\" * 1000)[:2000]


def counters(*values):
    return dict(zip(("processed", "stored", "rejected"), values))


def counted(run):
    assert run.pop("seconds") > 0
    run.pop("added")
    return run


def test_run_posts_twice_is_the_same_as_once(spark, dump_file, tmp_path):
    target, rejects = str(tmp_path / "features"), str(tmp_path / "rejects")
    for _ in range(2):
        assert counted(pp.run_posts(spark, dump_file, target, rejects)) == counters(11, 6, 5)
    assert sorted(r.id for r in read_features(spark, target).collect()) == [1, 4, 5, 6, 10, 11]
    assert read_appended(spark, rejects, reject_schema(POSTS), "json").count() == 5


def test_run_users_and_comments_append(spark, tmp_path):
    users, comments = tmp_path / "users.xml", tmp_path / "comments.xml"
    users.write_text('<users>\n<row Id="-1" Reputation="1" DisplayName="C" Location="Tbilisi" AboutMe="&lt;p&gt;A  PhD&lt;/p&gt;" WebsiteUrl="" />\n<row Id="2" Reputation="x" />\n</users>')
    comments.write_text('<comments>\n<row Id="1" PostId="4" Score="2" Text="why?" UserId="7" />\n</comments>')
    for run in (None, None, "again"):  # the same dump once, unless it is named as another run
        assert counted(pu.run_users(spark, str(users), str(tmp_path / "u"), str(tmp_path / "ur"), run=run)) == counters(2, 1, 1)
        assert counted(pc.run_comments(spark, str(comments), str(tmp_path / "c"), run=run)) == counters(1, 1, 0)
    rows = read_users(spark, str(tmp_path / "u")).collect()
    assert len(rows) == 2 and read_rejects(spark, str(tmp_path / "ur"), USERS).count() == 1
    assert (rows[0].Id, rows[0].AboutMe, rows[0].UserType, rows[0].Degree, rows[0].Country, rows[0].Continent) == (
        -1, "<p>a phd</p>", "Academic", "PhD", "georgia", "Asia")
    assert [r.CommentClass for r in read_comments(spark, str(tmp_path / "c")).collect()] == ["Clarification Seeking"] * 2


def test_xml_round_trip(spark, tmp_path):
    values = ["", " a ", "x<b>&amp;\"'", "line\nbreak\ttab\rend", "\u00e9\u0301 \U0001f600 />", None]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "Id string, Text string")
    dump.to_dump_lines(df).write.text(str(tmp_path / "d"))
    got = dump.scan_dump(spark, str(tmp_path / "d"), {"Id": "bigint", "Text": "string"}).orderBy("Id").collect()
    assert [r.Text for r in got] == values


def feature_rows(spark, pairs):
    df = spark.createDataFrame(pairs, "id long, posttypeid int, score int")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in POSTS_FEATURES])


def test_split(spark):
    features = feature_rows(spark, [(3, 1, 0), (4, 1, 0), (78_300_003, 2, 0), (78_300_004, 2, 0), (100_004, 1, 0), (9, 3, 0)])
    assert sorted(r.id for part in split.split_posts(features) for r in part.collect()) == [
        3, 4, 100_004, 78_300_003, 78_300_004]
    questions, answers = split.split_posts(features, split.MIN_ID, split.last_id())
    assert sorted(r.id for r in questions.collect()) == [4, 100_004]
    assert [r.id for r in answers.collect()] == [78_300_003]
    assert questions.columns == SPLIT_COLUMNS and "body" not in SPLIT_COLUMNS
    assert sorted(r.range_start for r in split.with_range(questions).collect()) == [4, 100_004]


def test_split_reaches_the_scan(spark, tmp_path):
    feature_rows(spark, [(4, 1, 0)]).write.parquet(str(tmp_path / "f"))
    questions, _ = split.split_posts(spark.read.parquet(str(tmp_path / "f")), 4, 9)
    plan = questions._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,4)" in plan and "EqualTo(posttypeid,1)" in plan
    assert "body" not in plan.split("ReadSchema")[1]


def scores(spark, path, **bounds):
    return sorted((r.id, r.score) for r in read_features(spark, path, **bounds).collect())


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, feature_rows(spark, [(1, 1, 10), (2, 1, 20), (1500, 2, 30)]), path, step=1000)
    sinks.upsert(spark, feature_rows(spark, [(2, 1, 21), (3, 1, 31), (3, 1, 31)]), path)
    assert scores(spark, path) == [(1, 10), (2, 21), (3, 31), (1500, 30)]
    folders = [sorted(f.name for f in d.iterdir() if f.is_dir()) for d in (tmp_path / "t" / "data").iterdir()]
    assert sorted(folders) == [["id_range=0"], ["id_range=0", "id_range=1000"]]  # the other range is not written again
    assert not [f for f in (tmp_path / "t").iterdir() if f.name.startswith("_staged")]
    assert scores(spark, path, min_id=2, max_id=1499) == [(2, 21), (3, 31)]
    assert len(read_features(spark, path, min_id=1000).inputFiles()) == 1


def test_upsert_keeps_to_the_ranges_of_its_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, feature_rows(spark, [(1500, 1, 10)]), path, step=1000)
    with pytest.raises(ValueError, match="ranges of 1000"):
        sinks.upsert(spark, feature_rows(spark, [(1500, 1, 11)]), path, step=500)
    sinks.upsert(spark, feature_rows(spark, [(1500, 1, 12)]), path)
    assert scores(spark, path) == [(1500, 12)]


def test_upsert_refuses_null_keys_and_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, feature_rows(spark, [(1, 1, 10)]), path, step=1000)
    with pytest.raises(Exception, match="NULL in key"):
        sinks.upsert(spark, feature_rows(spark, [(1, 1, 11), (None, 1, 12)]), path)
    assert scores(spark, path) == [(1, 10)]


def test_upsert_of_nothing_makes_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, feature_rows(spark, [(1, 1, 10)]).where("false"), path)
    assert scores(spark, path) == []
    sinks.upsert(spark, feature_rows(spark, [(1, 1, 10)]), path)
    assert scores(spark, path) == [(1, 10)]


def test_upsert_takes_the_last_of_a_hot_key(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("id"),
        F.col("id").alias("version"))
    sinks.upsert(spark, rows, str(tmp_path / "t"), order=["version"], step=500)
    got = {r.id: r.version for r in sinks.read_table(spark, str(tmp_path / "t"), rows.schema).collect()}
    assert got[7] == 2997 and len(got) == 2001 - (1 if 7 % 3 else 0) + (0 if 7 % 3 else 1)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = sinks.latest_per_key(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], [F.col("id").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit [k") < plan.index("Exchange") < plan.rindex("WindowGroupLimit [k")


def test_create_and_append(spark, tmp_path):
    sinks.create_if_absent(spark, "features_table", POSTS_FEATURES)
    sinks.create_if_absent(spark, "features_table", POSTS_FEATURES)
    assert spark.table("features_table").schema == POSTS_FEATURES
    spark.sql("DROP TABLE features_table")
    sinks.append(spark.range(0, 25, 1, 1), str(tmp_path / "a"), max_rows_per_file=10)
    sizes = sorted(r[0] for r in spark.read.parquet(str(tmp_path / "a")).groupBy(F.input_file_name()).count().select("count").collect())
    assert sizes == [5, 10, 10]


def test_streams(spark, tmp_path, dump_file):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.xml").write_text('<row Id="1" PostId="4" Score="2" Text="why?" UserId="7" />\n<row Id="x" />\n')
    args = [str(src), str(tmp_path / "out"), str(tmp_path / "state")]
    ingest.stream_comments(spark, *args).awaitTermination()
    (src / "b.xml").write_text('<row Id="2" PostId="4" Score="2" Text="thanks" />\n')
    ingest.stream_comments(spark, *args).awaitTermination()
    rows = sorted((r.Id, r.CommentClass) for r in spark.read.parquet(args[1]).collect())
    assert rows == [(1, "Clarification Seeking"), (2, "Improvement Suggestions")]
    assert [r.error_reason for r in spark.read.json(f"{args[1]}-rejected").collect()] == ["bad Id"]


def test_a_stream_refuses_a_table_that_a_batch_wrote(spark, tmp_path):
    src, target = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.xml").write_text('<row Id="1" PostId="4" Score="2" Text="why?" UserId="7" />\n')
    pc.run_comments(spark, str(src), target)
    with pytest.raises(ValueError, match="no stream wrote"):
        ingest.stream_comments(spark, str(src), target, str(tmp_path / "state"))
    assert read_comments(spark, target).count() == 1


def test_run_reads_rows_over_several_lines(spark, tmp_path):
    path = tmp_path / "c.xml"
    path.write_text('<comments>\n<row Id="1"\n PostId="4" Text="why?" />\n</comments>')
    assert counted(pc.run_comments(spark, str(path), str(tmp_path / "c"), reader="xml")) == counters(1, 1, 0)


def test_a_run_parses_the_dump_once(spark, dump_file, tmp_path, monkeypatch):
    scans = []
    monkeypatch.setitem(dump.READERS, "text", lambda *a: scans.append(a) or dump.scan_dump(*a).where(F.rand() >= 0))
    # Rows that change when they are computed again would not add up.
    out = pp.run_posts(spark, dump_file, str(tmp_path / "t"))
    assert len(scans) == 1 and counted(out) == counters(11, 6, 5)


def test_post_stream_replaces_by_id(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    args = [str(src), str(tmp_path / "out"), str(tmp_path / "state")]
    for i, score in enumerate((1, 2)):
        (src / f"{i}.xml").write_text("".join(f'<row Id="{k}" PostTypeId="1" Score="{score}" Body="b" />\n' for k in (5, 6 + i)))
        ingest.stream_posts(spark, *args, max_files=1, step=100).awaitTermination()
    assert sorted((r.id, r.score) for r in read_features(spark, args[1]).collect()) == [(5, 2), (6, 1), (7, 2)]


def test_user_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "u.xml").write_text('<row Id="1" Location="Caf\u00e9, NY" AboutMe="\u00c9 developer" />\n', encoding="utf-8")
    ingest.stream_users(spark, str(src), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert (row.Country, row.UserType, row.AboutMe) == ("usa", "Practical Developer", "e\u0301 developer")


class Cluster:
    conf = {"spark.master": "yarn"}


def test_work_folders_are_new_and_named_on_a_cluster(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = (work_folder(spark, "x") for _ in range(2))
    assert first != second and (not named or first.startswith(named))
    with pytest.raises(ValueError):
        work_folder(Cluster, "x")


def test_stream_of_elements_over_several_lines(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.xml").write_text('<comments>\n<row Id="1"\n  PostId="4"\n  Text="why?"/><row\nId="2" Score="x"></row>\n</comments>')
    args = [str(src), str(tmp_path / "out"), str(tmp_path / "state")]
    ingest.stream_comments(spark, *args, layout="xml").awaitTermination()
    assert [(r.Id, r.CommentClass) for r in spark.read.parquet(args[1]).collect()] == [(1, "Clarification Seeking")]
    assert [r.error_reason for r in spark.read.json(f"{args[1]}-rejected").collect()] == ["bad Score"]
