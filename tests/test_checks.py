"""Every registered query against its check SQL."""

from __future__ import annotations

import datetime
import decimal

import pytest

import __spark_entry__ as entry
from tidemark.plans import catalog

QUERIES = catalog.QUERIES
CHECKS = catalog.CHECKS


def _value(v):
    if isinstance(v, float):
        return ("num", round(v, 9))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, decimal.Decimal)):
        return ("num", round(float(v), 9))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return ("time", v.isoformat())
    return ("text", v)


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_value(row[i]) for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, duck, small_dir, name):
    df = QUERIES[name](spark, small_dir)
    expected = duck.sql(CHECKS[name])
    assert sorted(df.columns) == sorted(expected.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    assert _rows(df.collect(), df.columns) == _rows(expected.fetchall(), expected.columns)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_sentiment" in df.columns
