"""Queries over every table and every column, beside their SQL at the smallest scale."""

from pathlib import Path

import pytest
from oracle import TABLES, connect, spark_rows, sql_rows
from test_entry import FOLDER

import __spark_entry__
from sensormill.queries import streams

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", ["rows_per_table", "multiset_equality", "row_hash_differences", "stream_table"])
def test_query_equals_its_sql(spark, name):
    names, got = spark_rows(__spark_entry__.queries()[name](spark, FOLDER))
    sql_names, expected = sql_rows(connect(FOLDER), __spark_entry__.oracle_sql()[name])
    assert names == sql_names and got == expected


def test_every_table_is_counted(spark):
    counted = __spark_entry__.queries()["rows_per_table"](spark, FOLDER)
    assert {r.table_name for r in counted.collect()} == set(TABLES)


def test_changes_are_seen(spark):
    cases = __spark_entry__.queries()["multiset_equality"](spark, FOLDER)
    assert {r.compared: r.same for r in cases.collect()} == {"pieces": True, "price": False, "repeat": False}


def test_streams_carry_every_column(spark):
    given = set(spark.read.parquet(f"{FOLDER}/events.parquet").columns)
    assert set(streams._replayed_twice(spark, FOLDER).columns) >= given - {"ts"} | {"timestamp_ns"}
