"""Every registered query against its SQL, on the smallest test tables."""
import compare
import pytest
from conftest import SMALL

import __spark_entry__ as driver
from lakevault.plans.oracle import ORACLE as SQL
from lakevault.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = compare.connect(SMALL)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert SQL.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
