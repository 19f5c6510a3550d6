"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry

BASE = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(BASE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert oracle.compare(name, QUERIES[name](spark, BASE), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, BASE).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["constraint_code", "constraint_name"]
    assert df.count() == 10
