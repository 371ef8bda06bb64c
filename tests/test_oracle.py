"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
import oracle
from folioflow.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    oracle.compare(QUERIES[name](spark, oracle.SF_DIR), con, ORACLES[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
