"""Registry of named queries and the table mappings they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.timing import epoch_ns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Events as sensor rows: the user is the log, the event type the sensor."""
    events = table(spark, folder, "events")
    return events.select(
        F.col("user_id").cast("string").alias("log_id"),
        F.col("event_type").alias("sensor"),
        epoch_ns(events, "ts").alias("timestamp_ns"),
        "event_id",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


EVENT_FRAMES_SQL = """frames AS (
  SELECT CAST(user_id AS VARCHAR) AS log_id, event_type AS sensor, epoch_ns(ts) AS timestamp_ns, event_id, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""
