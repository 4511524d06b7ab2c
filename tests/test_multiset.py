import pytest
from pyspark.sql import functions as F

from sensormill.operators.multiset import (
    compare,
    differences,
    refuse_empty_source,
    row_differences,
    same_rows,
    summarise,
)

KEYS = "log_id string, sensor string, timestamp_ns bigint"
A, B, C = ("L", "lidar", 1), ("L", "lidar", 2), ("L", "ring_front_center", 1)


def sides(spark, source, table):
    return compare(spark.createDataFrame(source, KEYS), spark.createDataFrame(table, KEYS))


@pytest.mark.parametrize(
    ("source", "table", "missing", "extra", "duplicate", "completeness", "status"),
    [
        ([A, B], [B, A], [], [], [], 1.0, "ok"),
        ([A, B], [A, C], [B], [C], [], 0.5, "incomplete"),
        ([A], [A, A], [], [], [A], 1.0, "surplus"),
        ([A, A, B], [A, B], [A], [], [], 2 / 3, "incomplete"),
    ],
)
def test_counts_not_sets(spark, source, table, missing, extra, duplicate, completeness, status):
    compared = sides(spark, source, table)
    rows = differences(compared).collect()
    key = lambda r: (r.log_id, r.sensor, r.timestamp_ns)
    assert [key(r) for r in rows if r.missing] == missing
    assert [key(r) for r in rows if r.extra] == extra
    assert [key(r) for r in rows if r.duplicate] == duplicate
    summary = summarise(compared).first()
    assert (summary.completeness, summary.status) == (completeness, status)


def test_nothing_is_not_complete(spark):
    summary = summarise(sides(spark, [], [C]))
    row = summary.first()
    assert row.completeness is None and row.status == "empty_source"
    with pytest.raises(Exception, match="source has no keys: L"):
        refuse_empty_source(summary).collect()
    assert refuse_empty_source(summarise(sides(spark, [A], [A]))).first().status == "ok"


def test_null_keys_match(spark):
    none = (None, None, None)
    row = sides(spark, [none, none], [none]).first()
    assert (row.source_n, row.table_n, row.missing, row.extra) == (2, 1, 1, 0)


def test_rows_with_nan_and_signed_zero(spark):
    left = spark.createDataFrame([(float("nan"),), (0.0,), (1.0,)], "x double")
    right = spark.createDataFrame([(-0.0,), (float("nan"),), (1.0,), (1.0,)], "x double")
    found = row_differences(left, right, ["x"]).collect()
    assert sorted((r.left_n, r.right_n) for r in found) == [(0, 1), (1, 0), (1, 2)]
    assert not same_rows(left, right, ["x"]).first().same
    assert same_rows(left, left.orderBy(F.desc("x")), ["x"]).first().same


def test_equal_sets_with_other_multiplicity_are_not_the_same(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(1,), (1,)], "x int")
    row = same_rows(a, b, ["x"]).first()
    assert (row.left_rows, row.right_rows, row.same) == (1, 2, False)
