"""Referential checks over the canonical tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.functions.paths import is_log_id
from sensormill.operators.joins import last_per_key
from sensormill.schemas import EXPECTED_SENSORS, LIDAR


def calibrations(extrinsics: DataFrame, intrinsics: DataFrame, order: str = "row_index") -> DataFrame:
    """Extrinsics with their intrinsics, NULL where a sensor has none; of repeated names the last row counts."""
    key = ["log_id", "sensor_name"]
    outer = last_per_key(extrinsics, key, [order]).drop(order)
    inner = last_per_key(intrinsics, key, [order]).drop(order)
    return outer.join(inner, key, "left")


def dangling_calibrations(sensor_data: DataFrame, calibration: DataFrame) -> DataFrame:
    """Sensor rows that name a calibration their own commit does not hold. NULL names nothing and is fine."""
    known = calibration.select("calibration_id", "ingest_commit_id")
    return sensor_data.where(F.col("calibration_id").isNotNull()).join(
        known, ["calibration_id", "ingest_commit_id"], "left_anti"
    )


def lidar_references(sensor_data: DataFrame) -> DataFrame:
    """Lidar sweeps are in the ego frame already: rows counted must have no calibration."""
    return (
        sensor_data.where(F.col("sensor") == LIDAR)
        .groupBy("ingest_commit_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("calibration_id").alias("n_calibrated"))
    )


def missing_sensors(
    logs: DataFrame, present: DataFrame, expected: Sequence[str] = EXPECTED_SENSORS
) -> DataFrame:
    """Expected sensors a log has no row of. The expected set is fixed, so each log expands to a few rows."""
    wanted = logs.select("log_id", F.explode(F.array(*(F.lit(s) for s in expected))).alias("sensor"))
    return wanted.join(present.select("log_id", "sensor").distinct(), ["log_id", "sensor"], "left_anti")


def log_bounds(logs: DataFrame, sensor_data: DataFrame) -> DataFrame:
    """First and last stamp per log, 0 and 0 for a log without sensor rows."""
    bounds = sensor_data.groupBy("log_id").agg(
        F.min("timestamp_ns").alias("start_ns"), F.max("timestamp_ns").alias("end_ns")
    )
    zero = F.lit(0).cast("bigint")
    return logs.join(bounds, "log_id", "left").withColumns(
        {"start_ns": F.coalesce("start_ns", zero), "end_ns": F.coalesce("end_ns", zero)}
    )


def split_log_ids(df: DataFrame, column: str = "log_id") -> tuple[DataFrame, DataFrame]:
    """(rows with a plain log id, rows to refuse). Ids become folder names, so nothing else passes."""
    ok = is_log_id(F.col(column))
    return df.where(ok), df.where(~ok)


def in_scope(df: DataFrame, log_list: DataFrame) -> DataFrame:
    return df.join(log_list.select("log_id"), "log_id", "left_semi")


def filled_counts(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *(F.count(c).alias(f"n_{c}") for c in columns)
    )
