"""Every registered query against its SQL, on whole tables of the smallest data set."""

import pytest
from oracle_check import check, duck

import __spark_entry__ as entry_module
from tidemill.plans.catalog import REGISTRY


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(spark, small, con, name):
    ok, text = check(REGISTRY[name], spark, small, con)
    assert ok, text


def test_entry_points(spark):
    assert entry_module.entry(spark).columns[0] == "order_date"
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(REGISTRY) <= set(entry_module.queries())
    assert set(REGISTRY) == {n for n in entry_module.oracle_sql() if n in REGISTRY}
