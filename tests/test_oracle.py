"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as contract
from depotline.plans import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    frame = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql()[name]
    assert oracle.type_difference(frame, sql, connection) == []
    assert oracle.difference(frame, sql, connection) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["order_id", "order_total", "calculated_total"] and rows.count() > 0
