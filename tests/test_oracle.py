"""Every registered query against its DuckDB oracle on the smallest driver data."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert srows is not None
        return
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["investor_segment", "investor_count", "total_aum"]
    assert df.count() > 0
