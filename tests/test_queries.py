"""Every registered query against its SQL in DuckDB, on the smallest data."""

import glob
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_queries import rows_of  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(cols, want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
