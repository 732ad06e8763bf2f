"""Every registered query against its SQL."""

import os

import oracle
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: fn for name, fn in entry.queries().items() if fn.__module__.startswith("pairforge.plans")}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "val", "test"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    difference = oracle.compare(spark, duck, QUERIES[name], SQL[name], SF_DIR)
    assert difference is None, difference
