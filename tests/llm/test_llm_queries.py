"""Every query with SQL against it, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from threadloom.llm.oracle import ORACLE
from threadloom.llm.queries import QUERIES


def normal(df):
    def cell(v):
        return "" if pd.isna(v) else str(int(v)) if isinstance(v, (int, bool)) or hasattr(v, "dtype") and v.dtype != "O" else str(v)
    df = df[sorted(df.columns)].astype(object)
    return [tuple(df.columns), *sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False))]


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, sf, name):
    con = duckdb.connect()
    for file in os.listdir(sf):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
    assert normal(QUERIES[name](spark, sf).toPandas()) == normal(con.sql(ORACLE[name]).df())


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
