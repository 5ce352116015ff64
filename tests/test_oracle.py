"""Every registered query against its SQL, over whole tables at the smallest scale."""

import importlib

import pytest

import checker
from spanloom.plans import catalog, oracle

entry = importlib.import_module("__spark_entry__")
QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return checker.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert checker.compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
