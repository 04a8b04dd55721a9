"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01; tests/oracle_check.py does it
by hand)."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_oracle_keys_subset_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
