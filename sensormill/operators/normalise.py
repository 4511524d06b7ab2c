"""Canonical tables of many logs at once, as projections over file listings and Feather tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.functions.paths import relative_to, strip_scheme
from sensormill.operators.integrity import calibrations, log_bounds
from sensormill.schemas import (
    BOX_COLUMNS,
    INTRINSIC_COLUMNS,
    LIDAR,
    POSE_COLUMNS,
    TABLE_DDL,
    conform,
    table_schema,
)
from sensormill.sources.feather import read_tables

# Which files of a log folder are read, and the codec recorded for each kind.
POSE_FILE = "city_SE3_egovehicle.feather"
EXTRINSICS_FILE = "calibration/egovehicle_SE3_sensor.feather"
INTRINSICS_FILE = "calibration/intrinsics.feather"
ANNOTATION_FILE = "annotations.feather"
REQUIRED_FILES = (POSE_FILE, EXTRINSICS_FILE, INTRINSICS_FILE, ANNOTATION_FILE)
LIDAR_FRAME = r"^sensors/lidar/([0-9]+)\.feather\z"
CAMERA_FRAME = r"^sensors/cameras/([^/]+)/([0-9]+)\.jpg\z"
LIDAR_CODEC = "feather"
CAMERA_CODEC = "jpeg"
WRITE_ORDER = ("sensor_data", "pose", "calibration", "track", "log")
# End of fixed values.

_POSE = "timestamp_ns BIGINT, " + ", ".join(f"{c} DOUBLE" for c in POSE_COLUMNS)
_EXTRINSICS = "sensor_name STRING, " + ", ".join(f"{c} DOUBLE" for c in POSE_COLUMNS)
_INTRINSICS = "sensor_name STRING, " + ", ".join(f"{c} DOUBLE" for c in INTRINSIC_COLUMNS)
_ANNOTATIONS = (
    "timestamp_ns BIGINT, track_uuid STRING, category STRING, "
    + ", ".join(f"{c} DOUBLE" for c in (*BOX_COLUMNS, *POSE_COLUMNS))
    + ", num_interior_pts BIGINT"
)


def frames(hashed: DataFrame) -> DataFrame:
    """Sensor files among ``hashed`` (log_id, root, path, byte_size, checksum), with sensor, codec and stamp."""
    inside = relative_to(F.col("path"), F.col("root"))
    is_lidar = F.col("_inside").rlike(LIDAR_FRAME)
    is_camera = F.col("_inside").rlike(CAMERA_FRAME)
    digits = F.when(is_lidar, F.regexp_extract("_inside", LIDAR_FRAME, 1)).otherwise(
        F.regexp_extract("_inside", CAMERA_FRAME, 2)
    )
    return (
        hashed.withColumn("_inside", inside)
        .where(is_lidar | is_camera)
        .select(
            "log_id",
            F.when(is_lidar, F.lit(LIDAR)).otherwise(F.regexp_extract("_inside", CAMERA_FRAME, 1)).alias("sensor"),
            digits.alias("stamp"),
            digits.try_cast("bigint").alias("timestamp_ns"),
            strip_scheme(F.col("path")).alias("source_path"),
            "byte_size",
            "checksum",
            F.when(is_lidar, F.lit(LIDAR_CODEC)).otherwise(F.lit(CAMERA_CODEC)).alias("codec"),
        )
    )


def unreadable_stamps(hashed: DataFrame) -> DataFrame:
    """Sensor files whose digits do not fit a BIGINT: for quarantine."""
    return frames(hashed).where(F.col("timestamp_ns").isNull()).select("log_id", "sensor", "stamp", "source_path")


def _commit_of(logs: DataFrame) -> DataFrame:
    return logs.select("log_id", F.col("commit_id").alias("ingest_commit_id"))


def sensor_data(logs: DataFrame, hashed: DataFrame) -> DataFrame:
    calibration = F.when(F.col("sensor") != LIDAR, F.concat_ws("/", "log_id", "sensor"))
    rows = frames(hashed).where(F.col("timestamp_ns").isNotNull()).withColumn("calibration_id", calibration)
    return conform(rows.join(_commit_of(logs), "log_id"), table_schema("sensor_data"))


def _table_rows(logs: DataFrame, file: str, ddl: str) -> DataFrame:
    paths = logs.select("log_id", F.concat_ws("/", "root", F.lit(file)).alias("path"))
    return read_tables(paths, T.StructType.fromDDL(ddl))


def pose(logs: DataFrame) -> DataFrame:
    return conform(_table_rows(logs, POSE_FILE, _POSE).join(_commit_of(logs), "log_id"), table_schema("pose"))


def calibration(logs: DataFrame) -> DataFrame:
    joined = calibrations(
        _table_rows(logs, EXTRINSICS_FILE, _EXTRINSICS), _table_rows(logs, INTRINSICS_FILE, _INTRINSICS)
    )
    named = joined.withColumnRenamed("sensor_name", "sensor").withColumn(
        "calibration_id", F.concat_ws("/", "log_id", "sensor")
    )
    return conform(named.join(_commit_of(logs), "log_id"), table_schema("calibration"))


def track(logs: DataFrame) -> DataFrame:
    rows = _table_rows(logs, ANNOTATION_FILE, _ANNOTATIONS)
    return conform(rows.join(_commit_of(logs), "log_id"), table_schema("track"))


def log(logs: DataFrame, hashed: DataFrame, fill_digest: bool = False) -> DataFrame:
    """``city`` is unknown here and stays NULL; so does ``source_digest`` unless asked for."""
    stamps = frames(hashed).where(F.col("timestamp_ns").isNotNull()).select("log_id", "timestamp_ns")
    rows = log_bounds(logs, stamps).select(
        "log_id",
        F.lit(None).cast("string").alias("city"),
        "start_ns",
        "end_ns",
        strip_scheme(F.col("root")).alias("source_path"),
        (F.col("source_digest") if fill_digest else F.lit(None).cast("string")).alias("source_digest"),
        F.col("commit_id").alias("ingest_commit_id"),
    )
    return conform(rows, table_schema("log"))


def canonical_tables(logs: DataFrame, hashed: DataFrame, fill_digest: bool = False) -> dict[str, DataFrame]:
    """The five tables in the order they are written. ``logs`` has log_id, root, source_digest, commit_id."""
    tables = {
        "sensor_data": sensor_data(logs, hashed),
        "pose": pose(logs),
        "calibration": calibration(logs),
        "track": track(logs),
        "log": log(logs, hashed, fill_digest),
    }
    assert set(tables) == set(TABLE_DDL)
    return {name: tables[name] for name in WRITE_ORDER}


def without_required_files(folders: DataFrame, listed: DataFrame) -> DataFrame:
    """(log_id, file) for every table file a log folder lacks."""
    wanted = folders.select(
        "log_id",
        F.explode(F.array(*(F.lit(f) for f in REQUIRED_FILES))).alias("file"),
    )
    present = listed.select("log_id", relative_to(F.col("path"), F.col("root")).alias("file"))
    return wanted.join(present, ["log_id", "file"], "left_anti")
