"""Every query of the core against its SQL on the smallest input; those without SQL must give a stable schema and rows."""

import os

import pytest

from feedloom.plans import feeds, flows, problems, reference
from tests.oracle import connect, rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODULES = (reference, feeds, flows, problems)
QUERIES = {name: q for m in MODULES for name, q in m.queries().items()}
SQL = {name: q for m in MODULES for name, q in m.oracle_sql().items()}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER)
    if name in SQL:
        expected = con.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(expected.columns)
        assert rows(got.toPandas()) == rows(expected)
    else:
        assert got.columns and got.count() >= 0
