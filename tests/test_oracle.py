"""Every registered query with a SQL oracle agrees with DuckDB on sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerflow.plans import catalog
from ledgerflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
ORACLE = catalog.ORACLE


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    rel = con.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(rel.columns, rel.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sample_datetime", "amount_mean", "amount_sum", "type_nunique"]


def test_every_query_has_a_docstring_and_runs_lazily(spark):
    qs = entry.queries()
    assert len(qs) >= 70
    for name, fn in qs.items():
        assert fn.__doc__, name
