"""Every registered query against its SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if pd.isna(v):
            return ""
        return repr(round(float(v), 9)) if isinstance(v, (int, float)) else str(v)
    df = df[sorted(df.columns)].astype(object)
    return [tuple(df.columns), *sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False))]


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    assert normal(QUERIES[name](spark, SF).toPandas()) == normal(tables.sql(entry.oracle_sql()[name]).df())


def test_every_class_occurs(spark):
    def counts(query, column):
        return Counter(r[0] for r in QUERIES[query](spark, SF).select(column).collect())
    assert len(counts("comment_class", "CommentClass")) == 5
    assert len(counts("user_type", "UserType")) == 3
    assert len(counts("user_degree", "Degree")) == 8
    assert len(counts("user_continent", "continent")) >= 6
    assert len(counts("topic_class", "category")) == 6
    assert len(counts("code_language", "language")) == 6
    assert len(counts("typed_cast_reject", "error_reason")) >= 5


def test_entry(spark):
    assert entry.entry(spark).count() == 200
