"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert compare(spark, duck, SF_DIR, QUERIES[name], ORACLES.get(name)) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_no_oracle_without_query():
    assert set(ORACLES) <= set(QUERIES)
