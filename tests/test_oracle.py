"""Registered queries against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from verify.compare import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.oracle_sql() if n.startswith(("m0", "m1", "m2", "ml04", "ml08", "ml15", "src01", "src04"))]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_equal(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["from_status", "to_status", "n_transitions"]
