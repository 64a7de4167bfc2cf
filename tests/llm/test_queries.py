import os
import pathlib

import pytest

from feedloom.llm import queries
from tests.oracle import connect, rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    got = queries.queries()[name](spark, FOLDER)
    if name in queries.oracle_sql():
        assert rows(got.toPandas()) == rows(connect(FOLDER).sql(queries.oracle_sql()[name]).df())
    else:
        assert got.columns and got.count() >= 0


def test_nothing_outside_imports_the_package():
    root = pathlib.Path(queries.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "feedloom.llm" not in path.read_text(), path
