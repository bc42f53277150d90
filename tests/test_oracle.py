"""Every registered query against its SQL, and the contract's entry points."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_table_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, name) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(QUERIES) == set(ORACLE)
