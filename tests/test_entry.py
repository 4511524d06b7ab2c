"""The registered queries at the smallest scale: they run, and every one with SQL has the columns of its SQL."""

import os
from pathlib import Path

import pytest
from oracle import connect, plain, spark_rows, sql_rows

import __spark_entry__

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")
# All queries run beside their SQL with `python tests/oracle.py`; here is one of each kind.
SHOWN = (
    "reconcile_summary row_hash_lineitem digest_per_log fingerprint_orders nearest_skew visible_rows quality_mart "
    "release_pin stream_equals_batch top_vectors_per_label"
).split()


def test_names_match():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(__spark_entry__.queries()) >= 70


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert {"empty_source", "incomplete"} <= {r.status for r in rows}


@pytest.mark.parametrize("name", SHOWN)
def test_query_equals_its_sql(spark, name):
    names, got = spark_rows(__spark_entry__.queries()[name](spark, FOLDER))
    sql_names, expected = sql_rows(connect(FOLDER), __spark_entry__.oracle_sql()[name])
    assert names == sql_names and got == expected
    assert plain(float("nan")) == "nan" and os.path.isdir(FOLDER)


def test_results_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("row_hash_orders", "stream_window_counts", "latest_activation_as_of"):
            _, got = spark_rows(__spark_entry__.queries()[name](spark, FOLDER))
            _, expected = sql_rows(connect(FOLDER), __spark_entry__.oracle_sql()[name])
            assert got == expected, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
