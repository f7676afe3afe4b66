from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return ""
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
