"""Every registered query against its DuckDB oracle on the smallest shared tables (the driver
runs the same comparison at sf0.01)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from keyfig.sources.binding import TABLES

SQL = E.oracle_sql()
#: The inventory's queries; the training-data ones have tests of their own.
KEYS = sorted(k for k in E.queries() if not k.startswith("op") and k != "pipeline")


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    assert set(KEYS) <= set(SQL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, rows) == canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "affordability_tier" in df.columns
