"""Canonical tables. Schemas are fixed text: nothing is inferred, so all-null columns keep their type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names, order and types of the canonical columns, the sensor names and the log-id pattern
# are part of the results and must stay exactly as they are.
POSE_COLUMNS = ("qw", "qx", "qy", "qz", "tx_m", "ty_m", "tz_m")
INTRINSIC_COLUMNS = ("fx_px", "fy_px", "cx_px", "cy_px")
BOX_COLUMNS = ("length_m", "width_m", "height_m")
TABLE_DDL = {
    "log": "log_id STRING, city STRING, start_ns BIGINT, end_ns BIGINT, source_path STRING, "
    "source_digest STRING, ingest_commit_id STRING",
    "sensor_data": "log_id STRING, sensor STRING, timestamp_ns BIGINT, source_path STRING, byte_size BIGINT, "
    "checksum STRING, codec STRING, calibration_id STRING, ingest_commit_id STRING",
    "pose": "log_id STRING, timestamp_ns BIGINT, qw DOUBLE, qx DOUBLE, qy DOUBLE, qz DOUBLE, "
    "tx_m DOUBLE, ty_m DOUBLE, tz_m DOUBLE, ingest_commit_id STRING",
    "calibration": "log_id STRING, sensor STRING, calibration_id STRING, qw DOUBLE, qx DOUBLE, qy DOUBLE, "
    "qz DOUBLE, tx_m DOUBLE, ty_m DOUBLE, tz_m DOUBLE, fx_px DOUBLE, fy_px DOUBLE, cx_px DOUBLE, "
    "cy_px DOUBLE, ingest_commit_id STRING",
    "track": "log_id STRING, timestamp_ns BIGINT, track_uuid STRING, category STRING, length_m DOUBLE, "
    "width_m DOUBLE, height_m DOUBLE, qw DOUBLE, qx DOUBLE, qy DOUBLE, qz DOUBLE, tx_m DOUBLE, ty_m DOUBLE, "
    "tz_m DOUBLE, num_interior_pts BIGINT, ingest_commit_id STRING",
}
PARTITION_COLUMNS = {"sensor_data": ("log_id",), "track": ("log_id",)}
RING_CAMERAS = (
    "ring_front_center",
    "ring_front_left",
    "ring_front_right",
    "ring_rear_left",
    "ring_rear_right",
    "ring_side_left",
    "ring_side_right",
)
STEREO_CAMERAS = ("stereo_front_left", "stereo_front_right")
LIDAR = "lidar"
EXPECTED_SENSORS = (*RING_CAMERAS, *STEREO_CAMERAS, LIDAR)
LOG_ID_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9_-]*\z"
# End of fixed values.

LEDGER_DDL = (
    "seq BIGINT, log_id STRING, commit_id STRING, source_digest STRING, transform_version STRING, "
    "snapshots MAP<STRING, BIGINT>, recorded_at TIMESTAMP"
)
SOURCE_KEY = ("log_id", "sensor", "timestamp_ns")


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_DDL[table])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the fields of ``schema`` in order, cast to its types; absent fields become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
