"""Source-side keys, taken from file names alone.

Reconciliation needs a second opinion, so this module uses nothing of the package: a mistake in shared rules would go
unseen on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Where sensors lie inside a log folder, and which file names carry a stamp (digits, any one suffix).
STAMPED_FILE = r"/([^/]+)/sensors/(?:(lidar)|cameras/([^/]+))/([0-9]+)(?:\.[^./]+)?\z"
# End of fixed values.


def keys_of_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """(log_id, sensor, timestamp_ns), one row per stamped file whatever its suffix.

    ``timestamp_ns`` is NULL where the digits do not fit; such rows belong into quarantine.
    """
    path = F.col(column)
    log_id, lidar, camera, stamp = (F.regexp_extract(path, STAMPED_FILE, i) for i in (1, 2, 3, 4))
    return paths.where(path.rlike(STAMPED_FILE)).select(
        log_id.alias("log_id"),
        F.when(lidar != "", lidar).otherwise(camera).alias("sensor"),
        stamp.try_cast("bigint").alias("timestamp_ns"),
    )


def _folder(path: str):
    """(file system, plain folder, what goes before plain paths). Names are never parsed as URIs."""
    from pyarrow import fs

    scheme, found, rest = path.partition("://")
    if not found:
        return fs.LocalFileSystem(), path.removeprefix("file:"), "file:" if path.startswith("file:") else ""
    authority, _, inside = rest.partition("/")
    if scheme == "file":
        return fs.LocalFileSystem(), f"/{inside}", f"file://{authority}"
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    base = base.rstrip("/")
    return system, f"{base}/{inside}", f"{scheme}://{authority}".removesuffix(base)


def _children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Files and folders directly below each path; a folder that does not exist holds nothing."""
    from pyarrow import fs

    for batch in batches:
        for row in batch.itertuples(index=False):
            system, base, before = _folder(row.path)
            found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
            if found:
                yield pd.DataFrame(
                    {"path": [before + i.path for i in found], "is_file": [i.type == fs.FileType.File for i in found]}
                )


def source_keys(folders: DataFrame) -> DataFrame:
    """Keys of every log in ``folders`` (log_id, root). Directories are listed by tasks; no payload is opened.

    A scan with Spark's file index would bring every path to the driver, which does not hold for 10^8 frames.
    """
    listed = "path string, is_file boolean"
    root = F.col("root")
    # An explicit number of partitions: folders are small as rows, but each is a listing to wait for.
    spark = folders.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    cameras = folders.select(F.concat(root, F.lit("/sensors/cameras")).alias("path")).repartition(tasks, "path")
    camera_folders = cameras.mapInPandas(_children, listed).where("NOT is_file").select("path")
    lidar = folders.select(F.concat(root, F.lit("/sensors/lidar")).alias("path"))
    frames = lidar.unionByName(camera_folders).repartition(tasks, "path").mapInPandas(_children, listed)
    return keys_of_paths(frames.where("is_file").select("path"))


def sensor_counts(keys: DataFrame) -> DataFrame:
    """Frames per log and sensor: the denominator of completeness."""
    return keys.groupBy("log_id", "sensor").agg(F.count(F.lit(1)).alias("n_frames"))


def scene_keys(spark: SparkSession, root: str) -> DataFrame:
    """One row per frame of the second layout, straight from its files and without the transform or its reader.

    Samples grow with the frames, so they are merged and never broadcast.
    """

    def rows(name: str, ddl: str) -> DataFrame:
        return spark.read.schema(ddl).option("multiLine", "true").json(f"{root}/{name}.json")

    samples = rows("sample", "token STRING, scene_token STRING").select(F.col("token").alias("sample_token"), "scene_token")
    scenes = rows("scene", "token STRING, name STRING").select(F.col("token").alias("scene_token"), F.col("name").alias("log_id"))
    mounted = rows("calibrated_sensor", "token STRING, sensor_token STRING").select(F.col("token").alias("calibrated_sensor_token"), "sensor_token")
    sensors = rows("sensor", "token STRING, channel STRING, modality STRING").select(F.col("token").alias("sensor_token"), "channel", "modality")
    data = rows("sample_data", "sample_token STRING, calibrated_sensor_token STRING, timestamp BIGINT")
    joined = data.join(samples.hint("merge"), "sample_token").join(scenes, "scene_token").join(mounted, "calibrated_sensor_token").join(sensors, "sensor_token")
    sensor = F.when(F.col("modality") == "lidar", "lidar").otherwise(F.lower("channel"))
    return joined.select("log_id", sensor.alias("sensor"), (F.col("timestamp") * 1000).alias("timestamp_ns"))
