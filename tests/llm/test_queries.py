"""Queries with an SQL form against it, and that each query is registered."""

import pytest

import __spark_entry__ as entry_module
from quayside.llm.queries import ORACLES, QUERIES
from tests.compare import actual, duck, expected


def test_registered():
    found = entry_module.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert set(ORACLES) <= set(entry_module.oracle_sql())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == sorted(int(name[2:].split("_")[0]) for name in QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, sf_dir, name):
    assert actual(QUERIES[name](spark, sf_dir)) == expected(duck(sf_dir), ORACLES[name])
