"""Every registered query against its SQL over whole tables, and the driver contract."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, duck
from shelfwise import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract(spark):
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(contract.queries())
    profile = contract.entry(spark)
    assert profile.count() > 0 and "aging_bucket" in profile.columns


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SF) == ""
