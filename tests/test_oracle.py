"""Every query with SQL equals that SQL in DuckDB on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from sf_data import DATA

SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(None if r[i] is None else str(r[i]) for i in places) for r in rows]
    return [columns[i] for i in places], sorted(plain, key=lambda r: tuple((v is None, v or "") for v in r))


def test_sql_names_are_queries():
    assert set(SQL) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, DATA)
    cursor = duck.execute(SQL[name])
    expected = ordered([c[0] for c in cursor.description], cursor.fetchall())
    assert ordered(df.columns, df.collect()) == expected


def test_every_query_has_sql_or_a_test_of_its_own():
    """Queries of the corpus operators without SQL are compared with brute force in their own tests."""
    assert all(name.startswith("op") or name == "pipeline" for name in set(driver.queries()) - set(SQL))


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["class", "count", "pct"] and df.count() == 10
