"""Every registered query with SQL against DuckDB on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
NAMES = [n for n in QUERIES if n != "pipeline" and not n.startswith("op")]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(f"{float(v):.9g}")
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    if name not in ORACLES:
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
