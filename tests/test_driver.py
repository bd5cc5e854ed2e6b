from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


ADDED = driver.training_data.queries() if driver.training_data else {}


def test_every_query_has_its_statement():
    # Those of the training-data package are held against plain versions where SQL ends.
    assert set(driver.queries()) - set(ADDED) == set(driver.oracle_sql()) - set(ADDED)


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    query = driver.queries()[name](spark, FOLDER)
    assert difference(query, connection, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 12
