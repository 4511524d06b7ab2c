"""A second dataset layout: scenes as relational JSON files, mapped onto the same canonical tables.

Each file is one JSON array (or a folder of such), read in byte ranges by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.schemas import LIDAR, conform, table_schema
from sensormill.sources.json_arrays import SPLIT, array_files, json_elements
from sensormill.streaming.replay import parsed_envelopes
from sensormill.workspace import materialise

# Names and fields of the files of this layout that are read.
FILES = {
    "scene": "token STRING, name STRING",
    "sample": "token STRING, scene_token STRING, timestamp BIGINT",
    "sample_data": "token STRING, sample_token STRING, ego_pose_token STRING, calibrated_sensor_token STRING, "
    "timestamp BIGINT, fileformat STRING, filename STRING",
    "ego_pose": "token STRING, timestamp BIGINT, rotation ARRAY<DOUBLE>, translation ARRAY<DOUBLE>",
    "calibrated_sensor": "token STRING, sensor_token STRING, rotation ARRAY<DOUBLE>, translation ARRAY<DOUBLE>, "
    "camera_intrinsic ARRAY<ARRAY<DOUBLE>>",
    "sensor": "token STRING, channel STRING, modality STRING",
    "sample_annotation": "sample_token STRING, instance_token STRING, rotation ARRAY<DOUBLE>, "
    "translation ARRAY<DOUBLE>, size ARRAY<DOUBLE>, num_lidar_pts BIGINT",
    "instance": "token STRING, category_token STRING",
    "category": "token STRING, name STRING",
}
# End of fixed values. Stamps are microseconds; rotations are w, x, y, z; sizes are width, length, height.


def read_scenes(spark: SparkSession, root: str, split: int = SPLIT) -> dict[str, DataFrame]:
    """The rows of every file, cut and parsed once and kept. A file with an element that does not fit its fields is refused."""
    return {name: _whole(json_elements(array_files(spark, f"{root}/{name}.json"), split), name, ddl) for name, ddl in FILES.items()}


def _whole(elements: DataFrame, name: str, ddl: str) -> DataFrame:
    parsed = parsed_envelopes(elements, "element", ddl)
    raw = F.when(F.col("_dead"), F.struct("path", F.substring("element", 1, 200).alias("raw"))).alias("_raw")
    kept = materialise(parsed.select("_e.*", raw), f"scene-{name}")
    bad = kept.agg(F.min("_raw").alias("bad")).first().bad
    if bad is not None:
        raise ValueError(f"{bad.path} holds an element that does not fit: {bad.raw}")
    return kept.drop("_raw", "_corrupt_record")


def _pose(rotation: Column, translation: Column) -> list[Column]:
    named = [(F.get(rotation, F.lit(i)), n) for i, n in enumerate(("qw", "qx", "qy", "qz"))]
    named += [(F.get(translation, F.lit(i)), n) for i, n in enumerate(("tx_m", "ty_m", "tz_m"))]
    return [c.alias(n) for c, n in named]


def canonical_scenes(files: dict[str, DataFrame], commit_id: str) -> dict[str, DataFrame]:
    """The canonical tables of all scenes; a scene is a log.

    Samples, poses and instances grow with the rows and are merged. By the size of its compressed file Spark would take a
    table for small that is many times as large in memory, and gather it in the driver to broadcast it.
    """
    scenes = files["scene"].select(F.col("token").alias("scene_token"), F.col("name").alias("log_id"))
    samples = files["sample"].select(F.col("token").alias("sample_token"), "scene_token", F.col("timestamp").alias("sample_us"))
    located = samples.join(scenes, "scene_token").select("sample_token", "log_id", "sample_us").hint("merge")
    sensors = files["sensor"].select(F.col("token").alias("sensor_token"), "channel", "modality")
    mounted = files["calibrated_sensor"].join(sensors, "sensor_token").withColumnRenamed("token", "calibrated_sensor_token")
    name = F.when(F.col("modality") == LIDAR, F.lit(LIDAR)).otherwise(F.lower("channel"))
    data = files["sample_data"].join(located, "sample_token").join(
        mounted.select("calibrated_sensor_token", name.alias("sensor"), "modality"), "calibrated_sensor_token"
    )
    calibration_id = F.when(F.col("modality") != LIDAR, F.concat_ws("/", "log_id", "calibrated_sensor_token"))
    stamp = (F.col("timestamp") * 1000).alias("timestamp_ns")
    commit = F.lit(commit_id).alias("ingest_commit_id")
    rows = data.select(
        "log_id", "sensor", stamp, F.col("filename").alias("source_path"), F.col("fileformat").alias("codec"), calibration_id.alias("calibration_id"), commit
    )
    used = data.select("log_id", "calibrated_sensor_token", "sensor").distinct()
    k = F.col("camera_intrinsic")

    def cell(i: int, j: int) -> Column:
        return F.get(F.get(k, F.lit(i)), F.lit(j))

    calibration = used.join(mounted.drop("sensor_token"), "calibrated_sensor_token").select(
        "log_id",
        "sensor",
        F.concat_ws("/", "log_id", "calibrated_sensor_token").alias("calibration_id"),
        *_pose(F.col("rotation"), F.col("translation")),
        cell(0, 0).alias("fx_px"),
        cell(1, 1).alias("fy_px"),
        cell(0, 2).alias("cx_px"),
        cell(1, 2).alias("cy_px"),
        commit,
    )
    poses = data.select("log_id", F.col("ego_pose_token").alias("token")).distinct().join(files["ego_pose"].hint("merge"), "token")
    category = files["instance"].join(
        files["category"].select(F.col("token").alias("category_token"), F.col("name").alias("category")), "category_token"
    ).select(F.col("token").alias("instance_token"), "category")
    boxes = files["sample_annotation"].join(located, "sample_token").join(category.hint("merge"), "instance_token", "left")
    track = boxes.select(
        "log_id",
        (F.col("sample_us") * 1000).alias("timestamp_ns"),
        F.col("instance_token").alias("track_uuid"),
        "category",
        F.get("size", F.lit(1)).alias("length_m"),
        F.get("size", F.lit(0)).alias("width_m"),
        F.get("size", F.lit(2)).alias("height_m"),
        *_pose(F.col("rotation"), F.col("translation")),
        F.col("num_lidar_pts").alias("num_interior_pts"),
        commit,
    )
    bounds = rows.groupBy("log_id").agg(F.min("timestamp_ns").alias("start_ns"), F.max("timestamp_ns").alias("end_ns"))
    tables = {
        "sensor_data": rows,
        "pose": poses.select("log_id", stamp, *_pose(F.col("rotation"), F.col("translation")), commit),
        "calibration": calibration,
        "track": track,
        "log": bounds.withColumn("ingest_commit_id", F.lit(commit_id)),
    }
    return {table: conform(df, table_schema(table)) for table, df in tables.items()}
