import pytest

from threadloom.llm import exact_dedup

ROWS = [(1, "a b", 0), (2, "ab", 0), (3, "a  b", 0), (4, " ab \n", 0), (5, None, 0), (6, "", 0), (7, " \t", 0), (8, "x", 0),
        (8, "x", 0), (None, "x ", 0), (None, "y", 0), (9, "y", 0), (10, "a\u00a0b", 0), (11, "z" * 500_000, 0), (12, "AB", 0)]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_marks(spark, broadcast_bytes):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, sha int")
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept)
                 for r in exact_dedup.mark_duplicates(df, broadcast_bytes=broadcast_bytes).collect())
    assert got == [(-1, -1, 3, True), (-1, 9, 2, False), (1, 4, 4, False), (2, 4, 4, False), (3, 4, 4, False), (4, 4, 4, True),
                   (5, 7, 3, False), (6, 7, 3, False), (7, 7, 3, True), (8, -1, 3, False), (8, -1, 3, False), (9, 9, 2, True),
                   (10, 10, 1, True), (11, 11, 1, True), (12, 12, 1, True)]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_rows_that_stay(spark, broadcast_bytes):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, sha int")
    kept = exact_dedup.drop_duplicates(df, broadcast_bytes=broadcast_bytes)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 7, 9, 10, 11, 12]


def test_one_of_equal_rows_stays(spark):
    df = spark.createDataFrame([(1, "a")] * 50, "doc_id bigint, text string")
    assert exact_dedup.drop_duplicates(df).count() == 1
    assert exact_dedup.mark_duplicates(df).where("kept").count() == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.mark_duplicates(df).count() == 0 and exact_dedup.drop_duplicates(df).count() == 0


def test_rows_surely_alone_are_not_shuffled(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2990 AS STRING) AS text")
    from threadloom.llm.work import Workspace
    with Workspace(spark) as work:
        rows = df.select(exact_dedup.digest(df.text).alias("sha"))
        maybe = exact_dedup.RepeatedBits(work, rows, "sha").mark(rows, "sha", "maybe").where("maybe").count()
    assert 20 <= maybe < 400
