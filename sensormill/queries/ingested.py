"""Ingest, stores and releases over a log tree that Spark tasks write from the documents.

The source is the log, the language the sensor (English plays lidar) and the id the stamp. The text is the payload, and
the table files of a log hold one row per document or per language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators import ledger as ledgers
from sensormill.plans.ingest import ingest
from sensormill.plans.reconcile import active_rows
from sensormill.plans.release import Releases
from sensormill.plans.store import ParquetStore
from sensormill.queries.registry import query, table
from sensormill.schemas import BOX_COLUMNS, INTRINSIC_COLUMNS, POSE_COLUMNS
from sensormill.sources.feather import scan
from sensormill.sources.files import log_folders
from sensormill.sources.paths import locate
from sensormill.workspace import fresh_path


def _write(path: str, data: bytes) -> None:
    system, name, _ = locate(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(name) as out:
        out.write(data)


class _Feather:
    """A Feather file that is written batch by batch, so that none of it is held."""

    def __init__(self, path: str, schema: pa.Schema):
        system, name, _ = locate(path)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(name)
        self.writer = pa.ipc.new_file(self.out, schema)
        self.schema = schema

    def write(self, columns: dict) -> None:
        content = pa.table({f.name: pa.array(columns[f.name], f.type) for f in self.schema}, schema=self.schema)
        self.writer.write_table(content, max_chunksize=1024)

    def close(self) -> None:
        self.writer.close()
        self.out.close()


def _payloads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, text in zip(batch["path"], batch["text"], strict=True):
            _write(path, text.encode())
        yield pd.DataFrame({"n": [len(batch)]})


def _schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


_POSES = _schema(timestamp_ns=pa.int64(), **dict.fromkeys(POSE_COLUMNS, pa.float64()), unused=pa.string())
_BOXES = _schema(
    timestamp_ns=pa.int64(), track_uuid=pa.string(), category=pa.string(),
    **dict.fromkeys((*BOX_COLUMNS, *POSE_COLUMNS), pa.float64()), num_interior_pts=pa.int64(),
)
_MOUNTED = _schema(sensor_name=pa.string(), **dict.fromkeys(POSE_COLUMNS, pa.float64()))
_INNER = _schema(sensor_name=pa.string(), **dict.fromkeys(INTRINSIC_COLUMNS, pa.float64()))


def _streamed(batches: Iterator[pd.DataFrame], files: dict[str, pa.Schema], columns: Callable[[pd.DataFrame], list[dict]]) -> Iterator[pd.DataFrame]:
    """Writes the files of every log, whose rows follow each other over batches; of a log no more than a batch is held."""
    root, written = None, []
    try:
        for batch in batches:
            for one, rows in batch.groupby("root", sort=False):
                if one != root:
                    while written:
                        written.pop().close()
                    root = one
                    for name, schema in files.items():
                        written.append(_Feather(f"{root}/{name}", schema))
                for file, content in zip(written, columns(rows), strict=True):
                    file.write(content)
            yield pd.DataFrame({"n": [len(batch)]})
    finally:
        while written:
            written.pop().close()


def _pose_and_boxes(rows: pd.DataFrame) -> list[dict]:
    stamps, sizes = rows["doc_id"].tolist(), rows["n_chars"].astype(float).tolist()
    pose = {c: sizes if c == "qw" else [0.0] * len(sizes) for c in POSE_COLUMNS}
    boxes = {c: sizes if c == "length_m" else [1.0] * len(sizes) for c in (*BOX_COLUMNS, *POSE_COLUMNS)}
    names = {"track_uuid": [f"t{i}" for i in stamps], "category": rows["lang"].tolist()}
    return [{"timestamp_ns": stamps, **pose, "unused": ["x"] * len(stamps)}, {"timestamp_ns": stamps, **names, **boxes, "num_interior_pts": stamps}]


def _calibration(counts: pd.DataFrame) -> list[dict]:
    seen = counts[counts["lang"] != "en"]
    mounted, inner = counts["n"].astype(float).tolist(), seen["n"].astype(float).tolist()
    return [{"sensor_name": counts["lang"].tolist(), **dict.fromkeys(POSE_COLUMNS, mounted)}, {"sensor_name": seen["lang"].tolist(), **dict.fromkeys(INTRINSIC_COLUMNS, inner)}]


def _table_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pose and annotations from rows sorted by root and doc_id."""
    return _streamed(batches, {"city_SE3_egovehicle.feather": _POSES, "annotations.feather": _BOXES}, _pose_and_boxes)


def _calibration_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The calibration files from the counts of each language, sorted by root and lang."""
    files = {"calibration/egovehicle_SE3_sensor.feather": _MOUNTED, "calibration/intrinsics.feather": _INNER}
    return _streamed(batches, files, _calibration)


def _tree(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    root = fresh_path(spark, "logs")
    documents = table(spark, folder, "documents")
    home = F.concat_ws("/", F.lit(root), "source")
    lidar = F.concat(home, F.lit("/sensors/lidar/"), "doc_id", F.lit(".feather"))
    camera = F.concat(home, F.lit("/sensors/cameras/"), "lang", F.lit("/"), "doc_id", F.lit(".jpg"))
    files = documents.select(F.when(F.col("lang") == "en", lidar).otherwise(camera).alias("path"), "text")
    if payloads:
        files.mapInPandas(_payloads, "n long").agg(F.sum("n")).collect()
    rows = documents.select(home.alias("root"), "doc_id", "lang", "n_chars")
    # A log has one file of each kind, so one task writes it; it streams from the sorted shuffle and holds no group.
    sorted_rows = rows.repartition("root").sortWithinPartitions("root", "doc_id")
    sorted_rows.mapInPandas(_table_files, "n long").agg(F.sum("n")).collect()
    counts = rows.where("lang IS NOT NULL").groupBy("root", "lang").agg(F.count("*").alias("n"))
    sorted_counts = counts.repartition("root").sortWithinPartitions("root", "lang")
    sorted_counts.mapInPandas(_calibration_files, "n long").agg(F.sum("n")).collect()
    return log_folders(documents.select(F.col("source").alias("log_id")).distinct(), root)


def _lake(spark: SparkSession, folder: str) -> tuple[ParquetStore, DataFrame]:
    folders, store = _tree(spark, folder), ParquetStore(spark, fresh_path(spark, "lake"))
    ingest(store, folders, "v1")
    return store, folders


@query(
    """SELECT source AS log_id, CASE lang WHEN 'en' THEN 'lidar' ELSE lang END AS sensor, doc_id AS timestamp_ns,
  CAST(strlen(text) AS BIGINT) AS byte_size, sha256(text) AS checksum, CASE lang WHEN 'en' THEN 'feather' ELSE 'jpeg' END AS codec,
  CASE lang WHEN 'en' THEN NULL ELSE source || '/' || lang END AS calibration_id FROM documents"""
)
def ingested_frames(spark: SparkSession, folder: str) -> DataFrame:
    store, folders = _lake(spark, folder)
    rows = active_rows(store, "sensor_data", folders)
    return rows.select("log_id", "sensor", "timestamp_ns", "byte_size", "checksum", "codec", "calibration_id")


@query("SELECT source AS log_id, doc_id AS timestamp_ns, CAST(n_chars AS DOUBLE) AS qw, 0.0::DOUBLE AS tz_m FROM documents")
def ingested_poses(spark: SparkSession, folder: str) -> DataFrame:
    store, folders = _lake(spark, folder)
    return active_rows(store, "pose", folders).select("log_id", "timestamp_ns", "qw", "tz_m")


@query(
    """SELECT source AS log_id, doc_id AS timestamp_ns, 't' || doc_id AS track_uuid, lang AS category,
  CAST(n_chars AS DOUBLE) AS length_m, doc_id AS num_interior_pts FROM documents"""
)
def ingested_tracks(spark: SparkSession, folder: str) -> DataFrame:
    store, folders = _lake(spark, folder)
    rows = active_rows(store, "track", folders)
    return rows.select("log_id", "timestamp_ns", "track_uuid", "category", "length_m", "num_interior_pts")


@query(
    """SELECT source AS log_id, lang AS sensor, source || '/' || lang AS calibration_id, CAST(count(*) AS DOUBLE) AS qw,
  CASE lang WHEN 'en' THEN NULL ELSE CAST(count(*) AS DOUBLE) END AS fx_px FROM documents GROUP BY source, lang"""
)
def ingested_calibrations(spark: SparkSession, folder: str) -> DataFrame:
    store, folders = _lake(spark, folder)
    return active_rows(store, "calibration", folders).select("log_id", "sensor", "calibration_id", "qw", "fx_px")


@query(
    """WITH l AS (SELECT source, min(doc_id) AS start_ns, max(doc_id) AS end_ns FROM documents GROUP BY source)
SELECT source AS log_id, start_ns, end_ns, 1 AS n_commits, 'unchanged' AS action FROM l"""
)
def ingest_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds of every log, and what a second ingest of the same tree does: nothing, under one commit per log."""
    store, folders = _lake(spark, folder)
    again = ingest(store, folders, "v1").logs.select("log_id", "action")
    rows = store.read("sensor_data")
    commits = ledgers.commit_ids(rows).groupBy("log_id").agg(F.count("*").cast("int").alias("n_commits"))
    bounds = active_rows(store, "log").select("log_id", "start_ns", "end_ns")
    return bounds.join(commits, "log_id").join(again, "log_id").select("log_id", "start_ns", "end_ns", "n_commits", "action")


@query(
    """SELECT 'sensor_data' AS table_name, count(*) AS n_rows FROM documents UNION ALL SELECT 'pose', count(*) FROM documents
UNION ALL SELECT 'track', count(*) FROM documents UNION ALL SELECT 'log', count(DISTINCT source) FROM documents
UNION ALL SELECT 'calibration', count(*) FROM (SELECT DISTINCT source, lang FROM documents)"""
)
def release_load(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table of a release that was pinned, left half done once, and loaded after the store went on."""
    store, folders = _lake(spark, folder)
    pins = Releases(store, fresh_path(spark, "releases"))
    half = spark.createDataFrame([("gone", "c")], "log_id string, commit_id string")
    pins._write("commits", half, "attempt_id", "an attempt that died")
    pins.create("r1", folders, "strict-1", "v1")
    ingest(store, folders, "v2")
    loaded = pins.load("r1")
    counts = None
    for name, rows in loaded.items():
        one = rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    """SELECT 'first' AS state, count(*) FILTER (quality = 0) AS n_rows FROM labels UNION ALL SELECT 'tagged',
  count(*) FILTER (quality = 0) FROM labels UNION ALL SELECT 'now', count(*) FROM labels"""
)
def store_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """A table after two appends: as of the first one, as of its tag, and now."""
    labels = table(spark, folder, "labels")
    store = ParquetStore(spark, fresh_path(spark, "states"), {"labels": labels.schema})
    store.ensure_tables()
    store.append("labels", labels.where("quality = 0"), 10)
    store.tag("release", "labels", store.snapshot_ids()["labels"])
    store.append("labels", labels.where("quality <> 0 OR quality IS NULL"), 20)
    states = {"first": 10, "tagged": store.tagged("release", "labels"), "now": store.snapshot_ids()["labels"]}
    counts = None
    for name, snapshot in states.items():
        one = store.read("labels", as_of=snapshot).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("state"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("SELECT CAST(n_chars AS DOUBLE) AS qw, doc_id AS timestamp_ns FROM documents")
def feather_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The pose files of the tree; folders are listed and files read by tasks."""
    root = _tree(spark, folder, payloads=False).select(F.regexp_replace("root", "/[^/]+$", "").alias("root")).first().root
    rows = scan(spark, root, T.StructType.fromDDL("timestamp_ns BIGINT, qw DOUBLE, unused STRING"))
    return rows.where("unused = 'x'").select("qw", "timestamp_ns")
