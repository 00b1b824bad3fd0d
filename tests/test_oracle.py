"""Every registered query with SQL against DuckDB; the smallest tables hold too few names for the stock cap."""

import math
import os

import pytest

import __spark_entry__ as entry
from tickerloom.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.01"
NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in NAMES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if hasattr(x, "year"):
        return str(x)[:10]
    return round(float(x), 5) + 0.0 if isinstance(x, int | float) or x.__class__.__name__ == "Decimal" else x


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted((tuple(map(cell, r)) for r in got.select(columns).collect()), key=str)
    found = duck.sql(ORACLE_SQL[name])
    assert sorted(found.columns) == columns
    expected = sorted((tuple(map(cell, r)) for r in found.select(*columns).fetchall()), key=str)
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry_and_registry(spark):
    assert entry.entry(spark).columns == ["date", "gross"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
