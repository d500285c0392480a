"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry_module
from quayside.plans.queries import QUERIES as PLAN_QUERIES
from tests.compare import actual, duck, expected

QUERIES = {name: query for name, query in entry_module.queries().items() if name in PLAN_QUERIES}
ORACLES = {name: sql for name, sql in entry_module.oracle_sql().items() if name in PLAN_QUERIES}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, connection, name):
    assert actual(QUERIES[name](spark, sf_dir)) == expected(connection, ORACLES[name])


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
