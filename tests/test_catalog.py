"""Every named query against its SQL twin on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from grantweave.catalog import all_queries
from check_queries import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, sql, name):
    df = queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = sql.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, cur.fetchall())
