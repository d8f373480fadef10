"""Every registered query against its SQL counterpart, exact values and types."""

import os

import compare
import pytest

import __spark_entry__ as driver
from oracle import ORACLE_SQL
from windrose.queries import QUERIES

# sf0.001 by default; WINDROSE_TEST_SF=0.01 or 0.1 checks the larger tables.
FOLDER = f"/root/testdata/sf{os.environ.get('WINDROSE_TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLE_SQL.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare.differences(df, connection, ORACLE_SQL[name]) == []


def test_entry_is_the_risk_board(spark):
    board = driver.entry(spark)
    assert board.columns[-1] == "recommended_action"
    assert board.count() == 5
