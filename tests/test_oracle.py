"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry(spark).count() > 0
