"""Reconciliation and multiset queries.

Line items play the source keys (supplier, line, order). The table side has lost the returned lines, got the accepted
finished lines twice, and holds keys of pending orders that no source has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.text import format_number
from sensormill.functions.timing import epoch_ns
from sensormill.operators.multiset import (
    compare,
    differences,
    key_counts,
    row_differences,
    same_rows,
    summarise,
)
from sensormill.queries.registry import EVENT_FRAMES_SQL, event_frames, query, table
from sensormill.sources.keys import sensor_counts


def _line_keys(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_suppkey").cast("string").alias("log_id"),
        F.col("l_linenumber").cast("string").alias("sensor"),
        F.col("l_orderkey").alias("timestamp_ns"),
    )


def source_side(spark: SparkSession, folder: str) -> DataFrame:
    return _line_keys(table(spark, folder, "lineitem"))


def table_side(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    pending = table(spark, folder, "orders").where("o_orderstatus = 'P'")
    extra = pending.select(
        F.lit("orders").alias("log_id"), F.lit("0").alias("sensor"), F.col("o_orderkey").alias("timestamp_ns")
    )
    kept = _line_keys(lines.where("l_returnflag <> 'R'"))
    again = _line_keys(lines.where("l_returnflag = 'A' AND l_linestatus = 'F'"))
    return kept.unionByName(again).unionByName(extra)


_SIDES = """k AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS log_id, CAST(l_linenumber AS VARCHAR) AS sensor, l_orderkey AS timestamp_ns,
         l_returnflag AS rf, l_linestatus AS ls FROM lineitem),
s AS (SELECT log_id, sensor, timestamp_ns, count(*) AS n FROM k GROUP BY ALL),
t AS (SELECT log_id, sensor, timestamp_ns, count(*) AS n FROM (
    SELECT log_id, sensor, timestamp_ns FROM k WHERE rf <> 'R'
    UNION ALL SELECT log_id, sensor, timestamp_ns FROM k WHERE rf = 'A' AND ls = 'F'
    UNION ALL SELECT 'orders', '0', o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY ALL),
c AS (
  SELECT coalesce(s.log_id, t.log_id) AS log_id, coalesce(s.sensor, t.sensor) AS sensor,
         coalesce(s.timestamp_ns, t.timestamp_ns) AS timestamp_ns,
         coalesce(s.n, 0) AS source_n, coalesce(t.n, 0) AS table_n
  FROM s FULL JOIN t ON s.log_id = t.log_id AND s.sensor = t.sensor AND s.timestamp_ns = t.timestamp_ns),
d AS (
  SELECT *, greatest(source_n - table_n, 0) AS missing,
         CASE WHEN source_n = 0 THEN table_n ELSE 0 END AS extra,
         CASE WHEN source_n > 0 THEN greatest(table_n - source_n, 0) ELSE 0 END AS duplicate FROM c)"""

_SUMMARY = (
    _SIDES
    + """,
g AS (
  SELECT log_id, CAST(sum(source_n) AS BIGINT) AS source_total, CAST(sum(table_n) AS BIGINT) AS table_total,
         CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(extra) AS BIGINT) AS extra,
         CAST(sum(duplicate) AS BIGINT) AS duplicate FROM d GROUP BY log_id),
r AS (
  SELECT *, CASE WHEN source_total > 0 THEN CAST(source_total - missing AS DOUBLE) / CAST(source_total AS DOUBLE) END
         AS completeness,
         CASE WHEN source_total = 0 THEN 'empty_source' WHEN missing > 0 THEN 'incomplete'
              WHEN extra > 0 OR duplicate > 0 THEN 'surplus' ELSE 'ok' END AS status FROM g)"""
)


@query(f"WITH {_SIDES} SELECT * FROM d WHERE missing > 0 OR extra > 0 OR duplicate > 0")
def reconcile_detail(spark: SparkSession, folder: str) -> DataFrame:
    return differences(compare(source_side(spark, folder), table_side(spark, folder)))


@query(f"WITH {_SUMMARY} SELECT * FROM r")
def reconcile_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarise(compare(source_side(spark, folder), table_side(spark, folder)))


@query(
    f"""WITH {_SUMMARY} SELECT log_id, status,
  log_id || ' completeness=' || coalesce(format('{{:.6f}}%', completeness * 100), 'none') || ' missing=' || missing
  || ' extra=' || extra || ' duplicate=' || duplicate AS line FROM r"""
)
def reconcile_report(spark: SparkSession, folder: str) -> DataFrame:
    figures = summarise(compare(source_side(spark, folder), table_side(spark, folder)))
    share = F.coalesce(format_number(F.col("completeness"), ".6%"), F.lit("none"))
    pieces = [F.col("log_id"), F.lit(" completeness="), share]
    for name in ("missing", "extra", "duplicate"):
        pieces += [F.lit(f" {name}="), F.col(name).cast("string")]
    return figures.select("log_id", "status", F.concat(*pieces).alias("line"))


@query(
    """SELECT side, l_orderkey, l_linenumber, count(*) AS n FROM (
  SELECT 'only_finished' AS side, * FROM (
    SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F'
    EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O')
  UNION ALL SELECT 'only_open' AS side, * FROM (
    SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O'
    EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F'))
GROUP BY ALL"""
)
def multiset_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Both directions of the multiset difference from one aggregation."""
    lines = table(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    both = compare(lines.where("l_linestatus = 'F'"), lines.where("l_linestatus = 'O'"), keys)
    surplus = F.col("source_n") - F.col("table_n")
    side = F.when(surplus > 0, F.lit("only_finished")).otherwise(F.lit("only_open"))
    return both.where(surplus != 0).select(side.alias("side"), *keys, F.abs(surplus).alias("n"))


_CASES = {
    "pieces": "SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL",
    "price": "SELECT * REPLACE (CASE WHEN o_orderkey % 500 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders",
    "repeat": "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 500 = 7",
}


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS compared, (SELECT count(*) FROM orders) AS left_rows, (SELECT count(*) FROM ({other})) AS right_rows,
NOT EXISTS (SELECT * FROM orders EXCEPT ALL SELECT * FROM ({other})) AND NOT EXISTS (SELECT * FROM ({other}) EXCEPT ALL SELECT * FROM orders) AS same"""
        for name, other in _CASES.items()
    )
)
def multiset_equality(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of the orders against their pieces, against a changed price and against a few rows twice."""
    orders = table(spark, folder, "orders")
    orders = orders.withColumn("o_orderdate", epoch_ns(orders, "o_orderdate"))
    few = F.col("o_orderkey") % 500 == 7
    price = F.when(few, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    others = {
        "pieces": orders.where(finished).unionByName(orders.where(~finished)),
        "price": orders.withColumn("o_totalprice", price),
        "repeat": orders.unionByName(orders.where(few)),
    }
    cases = [same_rows(orders, other, orders.columns).select(F.lit(name).alias("compared"), "*") for name, other in others.items()]
    return reduce(DataFrame.unionByName, cases)


@query(
    """WITH b AS (SELECT *, 1 AS s, 0 AS t FROM lineitem
  UNION ALL SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN l_tax + 1 ELSE l_tax END AS l_tax), 0 AS s, 1 AS t FROM lineitem
  UNION ALL SELECT *, 0 AS s, 1 AS t FROM lineitem WHERE l_returnflag = 'A'),
c AS (SELECT sum(s) AS left_n, sum(t) AS right_n FROM b
  GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
SELECT CAST(left_n AS BIGINT) AS left_n, CAST(right_n AS BIGINT) AS right_n, count(*) AS n_rows FROM c WHERE left_n <> right_n GROUP BY ALL"""
)
def row_hash_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Rows compared by canonical hash over all columns: the other side has another tax on returned lines and accepted ones twice."""
    lines = table(spark, folder, "lineitem")
    lines = lines.withColumn("l_shipdate", epoch_ns(lines, "l_shipdate"))
    tax = F.when(F.col("l_returnflag") == "R", F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    other = lines.withColumn("l_tax", tax).unionByName(lines.where("l_returnflag = 'A'"))
    found = row_differences(lines, other, lines.columns)
    return found.groupBy("left_n", "right_n").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def source_key_counts(spark: SparkSession, folder: str) -> DataFrame:
    return key_counts(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {EVENT_FRAMES_SQL} SELECT log_id, sensor, count(*) AS n_frames FROM frames GROUP BY ALL")
def frames_per_sensor(spark: SparkSession, folder: str) -> DataFrame:
    return sensor_counts(event_frames(spark, folder))
