"""Every registered query against its SQL statement on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from workload.check import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equal_to_sql(spark, duck, name):
    assert compare(contract.queries()[name](spark, SF), duck, contract.oracle_sql()[name]) == ""


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
