"""Queries that SQL can express, against DuckDB over the smallest tables."""

import duckdb
import pytest

from ledgerline.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.sql(queries.ORACLES[name]).df()
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    assert sorted(map(str, got[cols].itertuples(index=False, name=None))) == sorted(
        map(str, want[cols].itertuples(index=False, name=None)))
