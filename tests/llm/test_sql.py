"""The queries that have a SQL twin, over whole tables: values and types."""

import pytest

import compare
from tollbook.llm import queries, sql

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sql.SQL)
def test_query(spark, name):
    con = compare.connect(FOLDER)
    frame = queries.QUERIES[name](spark, FOLDER)
    columns, rows = compare.spark_result(frame)
    assert (columns, rows) == compare.sql_result(con, sql.SQL[name])
    assert rows
    assert compare.spark_types(frame) == compare.sql_types(con, sql.SQL[name])
