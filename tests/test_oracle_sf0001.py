"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import canon

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(cols, rows):
    return sorted(tuple(canon(r[i]) for i in range(len(cols))) for r in rows)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_ORACLES)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _rows(cols, [tuple(r[c] for c in cols) for r in df.select(*cols).collect()])
    rel = con.sql(entry.oracle_sql()[name])
    names = rel.columns
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = _rows(cols, [tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "CustomerId" in df.columns


def test_run_pipeline_counts(spark):
    out = entry.queries()["run_pipeline"](spark, SF).collect()
    staged = entry.queries()["stage_processing_data"](spark, SF).count()
    assert {r.Status for r in out} == {"Success"} and {r.RecordsProcessed for r in out} == {staged}
    assert {r.TableName: r.TableRows for r in out}["TempProcessingData"] == staged


@pytest.mark.parametrize("name,unfiltered", [
    ("purge_processed_queue", "SELECT count(*) FROM OrderProcessingQueue"),
    ("sales_performance_report", "SELECT count(*) FROM sales_report"),
    ("customer_segment_analysis", "SELECT count(*) FROM segment_report"),
    ("department_performance_report", "SELECT count(*) FROM department_report")])
@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_filters_take_rows_away(name, unfiltered, sf):
    """The purge deletes rows, and rows that earlier runs stored are not inserted again."""
    from ledgerline.oracle_sql import statement
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf{sf}/{t}.parquet')")
    kept = c.execute(f"SELECT count(*) FROM ({entry.oracle_sql()[name]})").fetchone()[0]
    assert 0 < kept < c.execute(statement(unfiltered)).fetchone()[0]
