"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as driver
from maskflow import catalog
from tests.oracle import assert_same, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    assert_same(result, duck, driver.oracle_sql()[name])


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
