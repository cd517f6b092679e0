"""Every registered query against its DuckDB oracle on the smallest tables."""

import collections
import datetime
import decimal

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE

ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _multiset(df.columns, rows) == _multiset(rel.columns, rel.fetchall())


def test_every_query_runs(spark):
    for name, fn in E.queries().items():
        if name not in ORACLES:
            df = fn(spark, SMOKE)
            assert df.count() >= 0, name


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "policy_id" in df.columns
