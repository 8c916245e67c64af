"""Every query with SQL is compared with DuckDB; the contract file is complete."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, compare

SQL = contract.oracle_sql()
RUNS = contract.queries()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    df = RUNS[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    assert compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_contract(spark):
    assert set(SQL) <= set(RUNS)
    assert contract.entry(spark).count() == 5
