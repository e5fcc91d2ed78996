"""Registered queries and their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import rows
from checks.views import TABLES

SF_DIR = "/root/testdata/sf0.001"
PAIRS = sorted(name for name in entry.oracle_sql() if not name.startswith("op"))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", PAIRS)
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, map(tuple, df.collect())) == rows(columns, cur.fetchall())
