"""Every registered query against its SQL."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from khodat.checks import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_its_sql_gives(spark, con, name):
    assert name in driver.oracle_sql()
    df = driver.queries()[name](spark, SF)
    assert difference(df, con, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
