"""Every registered query against its DuckDB oracle on the smallest test data."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
        return
    assert compare(spark, con, name, df, sql) == []


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["org_name", "org_code", "known", "alive", "unknown", "percentage"]
