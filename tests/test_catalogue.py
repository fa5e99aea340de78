"""Every registered query against its SQL twin, values and types."""

import pytest

import __spark_entry__ as entry
import compare
from tollbook.plans import catalogue, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) == set(oracle.SQL)
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, con, name):
    frame = catalogue.QUERIES[name](spark, FOLDER)
    sql = oracle.SQL[name]
    columns, rows = compare.spark_result(frame)
    expected_columns, expected = compare.sql_result(con, sql)
    assert columns == expected_columns
    assert rows == expected
    assert rows
    assert compare.spark_types(frame) == compare.sql_types(con, sql)


def test_entry(spark):
    assert entry.entry(spark).count() == 45
