"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from workload.check import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 100


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    problem = differences(spark, con, sf_dir, contract.queries()[name], contract.oracle_sql().get(name))
    assert problem is None, problem


def test_entry(spark):
    assert contract.entry(spark).count() > 0
