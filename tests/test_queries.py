"""All registered queries at the smallest scale against DuckDB."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as catalogue

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(n for n in catalogue.oracle_sql() if not n.startswith("op")))
def test_query(spark, duck, name):
    result = catalogue.queries()[name](spark, SF_DIR)
    assert difference(result, duck, catalogue.oracle_sql()[name]) is None


def test_entry(spark):
    assert catalogue.entry(spark).count() == 5000
