"""Versions of a table, published loads, dead letters and splits of changes."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from threadloom.operators import split
from threadloom.plans import comments as pc
from threadloom.plans import posts as pp
from threadloom.plans import users as pu
from threadloom.schemas import COMMENTS, POSTS, POSTS_FEATURES, USERS
from threadloom.sinks import tables as sinks
from threadloom.sinks import versions
from threadloom.sinks.dead_letters import ROW_HASH, read_rejects
from threadloom.sources import dump
from threadloom.sources.tables import read_comments, read_features, read_users


def features(spark, rows):
    """Feature rows of (id, type, score)."""
    values = {"id": "id", "posttypeid": "kind", "score": "score"}
    df = spark.createDataFrame(rows, "id long, kind int, score int")
    return df.select(*[F.col(values.get(f.name, "id")).cast(f.dataType).alias(f.name) if f.name in values
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in POSTS_FEATURES])


def scores(spark, path, **more):
    return sorted((r.id, r.score) for r in sinks.read_table(spark, path, POSTS_FEATURES, **more).collect())


# ---- versions ---------------------------------------------------------------------------

def test_versions_are_read_from_few_files(spark, tmp_path, monkeypatch):
    path, version = str(tmp_path / "t"), versions.Version()
    for i in range(34):
        version = versions.publish(spark, path, version, {str(i % 7): f"data/{i}"}, [str((i + 3) % 7)] if i % 5 == 0 else [], step=9)
    wanted = {}
    for i in range(34):
        if i % 5 == 0:
            wanted.pop(str((i + 3) % 7), None)
        wanted[str(i % 7)] = f"data/{i}"
    opened, real = [], versions.Files.read
    monkeypatch.setattr(versions.Files, "read", lambda self, name: opened.append(name) or real(self, name))
    now = versions.current(spark, path)
    assert (now.number, now.folders, now.properties) == (34, wanted, {"step": 9})
    assert len(opened) == 5  # back to the list of version 30
    assert versions.current(spark, path, 3).folders == {"0": "data/0", "1": "data/1", "2": "data/2"}
    with pytest.raises(ValueError, match="version 99"):
        versions.current(spark, path, 99)


def test_one_of_two_writers_of_a_part_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    start = versions.publish(spark, path, versions.Version(), {"0": "data/a", "1": "data/b"})
    versions.publish(spark, path, start, {"0": "data/c"})
    with pytest.raises(versions.ConcurrentWrite, match="changed 0"):
        versions.publish(spark, path, start, {"0": "data/d"})
    with pytest.raises(versions.ConcurrentWrite):
        versions.publish(spark, path, start, {}, ["0"])
    both = versions.publish(spark, path, start, {"1": "data/e"})  # another part: both are kept
    assert both.number == 3 and both.folders == {"0": "data/c", "1": "data/e"}


def test_upsert_that_another_writer_overtook(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.upsert(spark, features(spark, [(1, 1, 10), (1500, 1, 20)]), path, step=1000)
    real, late = sinks._write_ranges, []

    def slow(df, folder):
        real(df, folder)
        if not late:
            late.append(folder)
            sinks.upsert(spark, features(spark, [(2, 1, 30)]), path)

    monkeypatch.setattr(sinks, "_write_ranges", slow)
    with pytest.raises(versions.ConcurrentWrite):
        sinks.upsert(spark, features(spark, [(3, 1, 40)]), path)
    assert scores(spark, path) == [(1, 10), (2, 30), (1500, 20)]
    late.clear()
    sinks.upsert(spark, features(spark, [(1600, 1, 50)]), path)  # another range than that of the writer between
    assert scores(spark, path) == [(1, 10), (2, 30), (1500, 20), (1600, 50)]
    assert scores(spark, path, version=1) == [(1, 10), (1500, 20)]


def test_many_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        added = list(pool.map(lambda i: sinks.publish_append(spark, path, f"run{i % 9}", f"data/{i}"), range(18)))
    table = versions.current(spark, path)
    assert sum(added) == len(table.folders) == table.number == 9


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(12):
        sinks.upsert(spark, features(spark, [(1, 1, i), (1500 + 1000 * (i % 2), 2, i)]), path, step=1000)
    wanted = scores(spark, path)
    assert versions.vacuum(spark, path) == []  # all of it is young
    removed = versions.vacuum(spark, path, keep=2, min_age=0)
    assert removed and scores(spark, path) == wanted and scores(spark, path, version=11) != wanted
    assert sorted(f.name for f in (tmp_path / "t" / "manifest").glob("*.json"))[0] == f"{10:020d}.json"
    versions.vacuum(spark, path, min_age=0)
    left = [f for d in (tmp_path / "t" / "data").iterdir() for f in d.iterdir() if f.is_dir()]
    assert scores(spark, path) == wanted and len(left) == 3  # ranges 0, 1000, 2000
    with pytest.raises(ValueError, match="no version 1 "):
        versions.current(spark, path, 1)


def test_vacuum_leaves_what_a_writer_has_not_published(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, features(spark, [(1, 1, 1)]), path)
    folder = sinks.write_unpublished(spark.range(3), path)
    assert versions.vacuum(spark, path, min_age=60) == []
    assert versions.vacuum(spark, path, min_age=0) == [folder]


def test_table_created_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.ensure_table(spark, path, POSTS_FEATURES)
        assert read_features(spark, path).count() == versions.current(spark, path).number - 1 == 0
    sinks.upsert(spark, features(spark, [(1, 1, 1)]), path)
    sinks.ensure_table(spark, path, POSTS_FEATURES)
    assert scores(spark, path) == [(1, 1)]
    with pytest.raises(ValueError, match="other columns"):
        sinks.ensure_table(spark, path, spark.range(1).schema)


# ---- loads ------------------------------------------------------------------------------

@pytest.fixture
def users(tmp_path):
    path = tmp_path / "users.xml"
    path.write_text('<users>\n<row Id="1" Reputation="1" />\n<row Id="2" Reputation="x" />\n<row Id="3" />\n</users>')
    return str(path)


@pytest.mark.parametrize("fails_at", ["publish_append", "publish_rejects"])
def test_a_run_that_fails_after_writing_shows_nothing(spark, users, tmp_path, monkeypatch, fails_at):
    from threadloom.plans import load
    target = str(tmp_path / "u")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(load if fails_at == "publish_append" else load.dead_letters, fails_at, fail)
        with pytest.raises(OSError, match="lost"):
            pu.run_users(spark, users, target)
    assert read_users(spark, target).count() == 0
    assert read_rejects(spark, f"{target}-rejected", USERS).count() == (fails_at == "publish_append")
    out = pu.run_users(spark, users, target)
    assert out["added"] and out["stored"] == 2 and not pu.run_users(spark, users, target)["added"]
    assert sorted(r.Id for r in read_users(spark, target).collect()) == [1, 3]
    assert [r.Id for r in read_rejects(spark, f"{target}-rejected", USERS).collect()] == ["2"]


def test_audit(spark, users, tmp_path, monkeypatch):
    """Rows that get lost on their way to the table are noticed before anybody sees the others."""
    from threadloom.plans import load
    target, real = str(tmp_path / "u"), pu.users_processed
    monkeypatch.setattr(pu, "users_processed", lambda df, **o: real(df, **o).where("Id <> 3"))
    with pytest.raises(load.AuditFailed, match="1 rows written of 2"):
        pu.run_users(spark, users, target)
    assert read_users(spark, target).count() == 0


def test_dump_is_known_by_its_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    names = set()
    for text in ("<row />", "<row  />"):
        (tmp_path / "d" / "a.xml").write_text(text)
        names |= {dump.dump_id(spark, str(tmp_path / "d")) for _ in range(2)}
    (tmp_path / "d" / "b.xml").write_text("<row />")
    assert len(names | {dump.dump_id(spark, str(tmp_path / "d"))}) == 3


def test_compacted_runs_still_count(spark, users, tmp_path):
    target = str(tmp_path / "u")
    for run in ("a", "b", "c"):
        pu.run_users(spark, users, target, run=run)
    from threadloom.schemas import USERS_PROCESSED
    sinks.compact_appended(spark, target, USERS_PROCESSED)
    versions.vacuum(spark, target, min_age=0)
    assert len(list((tmp_path / "u" / "data").iterdir())) == 1
    assert sorted(r.Id for r in read_users(spark, target).collect()) == [1, 1, 1, 3, 3, 3]
    assert not pu.run_users(spark, users, target, run="b")["added"]
    with pytest.raises(ValueError, match="compacted"):
        read_users(spark, target, run="b")


def test_replay(spark, tmp_path):
    path, target = tmp_path / "c.xml", str(tmp_path / "c")
    path.write_text('<row Id="x1" Score="1" Text="why?" />\n<row Id="2" Score="y" />\n<row Id="3" />\n<row Id="z" Text="a & b" />\n')
    pc.run_comments(spark, str(path), target)
    waiting = read_rejects(spark, f"{target}-rejected", COMMENTS)
    assert sorted((r.Id, r.error_reason) for r in waiting.where("Id IS NOT NULL").collect()) == [("2", "bad Score"), ("x1", "bad Id")]
    assert waiting.where("Id IS NULL").select("_corrupt_record", ROW_HASH).dropna().count() == 1
    corrected = waiting.where("Id IS NOT NULL").withColumn("Id", F.regexp_replace("Id", "x", ""))
    for _ in range(2):  # also when the replay itself is repeated
        out = pc.replay_comments(spark, corrected, target, run="fix")
        assert (out["processed"], out["stored"], out["rejected"]) == (2, 1, 1)
        assert sorted(r.Id for r in read_comments(spark, target).collect()) == [1, 3]
        left = read_rejects(spark, f"{target}-rejected", COMMENTS)
        assert sorted((r.Id or "", r.error_reason) for r in left.collect()) == [("", "malformed row"), ("2", "bad Score")]
    assert read_rejects(spark, f"{target}-rejected", COMMENTS, resolved=True).count() == 3


# ---- split ------------------------------------------------------------------------------

def test_split_reads_its_source_once(spark, tmp_path):
    features(spark, [(i, i % 3 + 1, i) for i in range(30)]).write.parquet(str(tmp_path / "f"))
    seen = spark.sparkContext.accumulator(0)
    source, targets = spark.read.parquet(str(tmp_path / "f")), [str(tmp_path / n) for n in "qa"]
    tagged = source.mapInArrow(lambda batches: (seen.add(b.num_rows) or b for b in batches), source.schema)
    split.run_split(tagged, *targets, 4, 20, run="one")
    assert seen.value == 30
    split.run_split(tagged, *targets, 4, 20, run="one")
    for kind, target in zip((1, 2), targets):
        rows = sinks.read_appended(spark, target, split.SPLIT_SCHEMA).collect()
        assert sorted(r.id for r in rows) == [i for i in range(4, 21) if i % 3 + 1 == kind]
        assert {r.posttypeid for r in rows} == {kind}


def test_split_of_changes_reads_only_changed_ranges(spark, tmp_path, monkeypatch):
    source, *targets = (str(tmp_path / n) for n in "fqa")
    read, real = [], sinks._read_folders
    monkeypatch.setattr(sinks, "_read_folders", lambda s, p, folders, schema: read.append((p, set(folders))) or real(s, p, folders, schema))

    def rows(kind):
        return sorted((r.id, r.score) for r in sinks.read_table(spark, targets[kind - 1], split.SPLIT_SCHEMA).collect())

    sinks.upsert(spark, features(spark, [(5, 1, 1), (1005, 2, 1), (1006, 1, 1), (2005, 2, 1), (2006, 3, 1)]), source, step=1000)
    assert split.split_changes(spark, source, *targets) == {0, 1000, 2000}
    assert rows(1) == [(5, 1), (1006, 1)] and rows(2) == [(1005, 1), (2005, 1)]
    sinks.upsert(spark, features(spark, [(1005, 1, 2), (3005, 2, 2)]), source)
    read.clear()
    assert split.split_changes(spark, source, *targets) == {1000, 3000}
    assert (source, {"1000", "3000"}) in read and not any("0" in f for p, f in read if p == source)
    # The answer that became a question is gone from the answers.
    assert rows(1) == [(5, 1), (1005, 2), (1006, 1)] and rows(2) == [(2005, 1), (3005, 2)]
    assert split.split_changes(spark, source, *targets) == set()
    versions.vacuum(spark, source, min_age=0)
    sinks.upsert(spark, features(spark, [(5, 2, 9)]), source)
    assert split.split_changes(spark, source, *targets) == {0} and rows(2)[0] == (5, 9) and rows(1)[0] == (1005, 2)


# ---- elements over several lines --------------------------------------------------------

def elements(seed):
    """A dump whose elements are written in every way, and its rows."""
    rng, out, rows = random.Random(seed), ['<?xml version="1.0"?>\n<!DOCTYPE rows>\n<votes rows="0">\n'], []
    for i in range(300):
        value = rng.choice(["2", "/>", "a > b", "it's", "&lt;/row>", "&lt;row Id=&quot;9&quot;/&gt;", "x" * rng.randrange(300), "é日"])
        blank = rng.choice([" ", "\n", "\r\n\t", "   "])
        quote = rng.choice("\"'") if "'" not in value else '"'
        end = rng.choice(["/>", " />", "></row>", ">\n</row>", f"><extra a='{i}'/></row>"])
        out.append(f"<row{blank}Id={quote}{i}{quote}{blank}VoteTypeId{rng.choice(['=', ' = '])}{quote}{value}{quote}{rng.choice(['', blank])}{end}")
        out.append(rng.choice(["", "\n", "  \n\n", "<rowset a='1'/>", "<rows>no</rows>"]))
        rows.append((str(i), value.replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"')))
    return "".join(out) + "</votes>\n", sorted(rows)


@pytest.mark.parametrize("size", [17, 64, 333, 4096])
def test_elements_over_lines_are_split_without_loss(spark, tmp_path, size):
    """At every kind of edge between two splits: within a delimiter, a name, a value, a character."""
    from threadloom.schemas import VOTES
    text, rows = elements(size)
    path = tmp_path / "Votes.xml"
    path.write_text(text, encoding="utf-8", newline="")
    with_size = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0}
    old = {k: spark.conf.get(k) for k in with_size}
    try:
        for k, v in with_size.items():
            spark.conf.set(k, v)
        df = dump.scan_dump_elements(spark, str(path), VOTES)
        found = sorted((r.Id, r.VoteTypeId) for r in df.select("Id", "VoteTypeId").collect())
        parts = df.rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found == rows and parts >= path.stat().st_size // size


def test_elements_that_do_not_end_are_rejected(spark, tmp_path):
    from threadloom.schemas import CORRUPT, VOTES
    path = tmp_path / "v.xml"
    path.write_text('\n<votes>\n<row Id="1"\n/>\n<row Id="2" PostId="3 />\n<row Id="3" PostId=4/>\n<row\n/><row>\n</row><row Id="5')
    found = dump.scan_dump_elements(spark, str(path), VOTES).collect()
    assert sorted(r.Id or "" for r in found) == ["", "", "", "", "", "1"]
    assert sorted(r[CORRUPT].strip() for r in found if r[CORRUPT]) == ['<row Id="2" PostId="3 />', '<row Id="3" PostId=4/>', '<row Id="5']
    assert pc.run_comments(spark, str(path), str(tmp_path / "c"), reader="xml")["rejected"] == 5
