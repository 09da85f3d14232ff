"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from suite.check import differences, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


OWN = sorted(name for module in entry.MODULES for name in module.QUERIES)


def test_every_query_has_sql():
    assert set(OWN) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
