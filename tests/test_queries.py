"""Every named query against its check SQL on the smallest tables; those without SQL must give rows."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from tidemark.catalog.base import CHECKS, QUERIES

# Thirteen fits of 100 to 300 trees; tests of their own run them with few trees.
SLOW = {"tree_tuning", "tree_backtest"}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in CHECKS:
        problem, _ = compare(df, con, CHECKS[name])
        assert not problem
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
