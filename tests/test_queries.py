"""Every registered query beside its SQL."""

import os

import pytest
from check_queries import connect, difference

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    from siglake.plans.registry import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    assert difference(duck.execute(contract.oracle_sql()[name]).df(), got) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
