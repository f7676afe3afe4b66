from __future__ import annotations

import duckdb
import pytest

from tidemark.llm import registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = registry.queries()[name](spark, SF).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = columns[[c.endswith("_id") for c in columns].index(True)]
    a, b = (df[columns].sort_values(key).reset_index(drop=True) for df in (got, want))
    assert a.astype(str).equals(b.astype(str)) or (a.fillna(-1).astype(str).replace(r"\.0$", "", regex=True).equals(b.fillna(-1).astype(str).replace(r"\.0$", "", regex=True)))
