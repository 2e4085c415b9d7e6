"""Every registered query against its oracle SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    from tests.oracle import connect
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    problem = compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem in (None, "equal, but no rows")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["doc_id", "score"] and 0 < rows.count() <= 10
