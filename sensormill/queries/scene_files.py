"""The second dataset layout, written from the documents as JSON arrays and read back in byte ranges.

The source is the scene, the language the sensor (English plays lidar) and the id the stamp. Every frame also carries its
text in a field nobody reads, so the arrays hold quotes, brackets and escapes of every kind.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.operators import ledger as ledgers
from sensormill.plans.reconcile import active_rows
from sensormill.plans.scenes import ingest_scenes, reconcile_scenes
from sensormill.plans.store import ParquetStore
from sensormill.queries.ingested import _payloads
from sensormill.queries.registry import query, table
from sensormill.sources.json_arrays import read_array
from sensormill.sources.paths import locate
from sensormill.workspace import fresh_path

#: Small against the files, so that every file is many ranges.
_SPLIT = 1 << 16


def _arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One array file per folder and task; its rows are streamed."""
    from pyspark import TaskContext

    task, current, out = TaskContext.get().partitionId(), None, None

    def end() -> None:
        if out is not None:
            out.write(b"\n]\n")
            out.close()

    for batch in batches:
        for folder, rows in batch.groupby("folder", sort=False):
            if folder != current:
                end()
                system, name, _ = locate(f"{folder}/part-{task}.json")
                system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                current, out = folder, system.open_output_stream(name)
                out.write(b"[\n")
                rows = rows.reset_index(drop=True)
                out.write(rows["element"].iloc[0].encode())
                rows = rows.iloc[1:]
            for element in rows["element"]:
                out.write(b",\n" + element.encode())
        yield pd.DataFrame({"n": [len(batch)]})
    end()


def _write_arrays(rows: DataFrame, folder: str) -> None:
    elements = rows.select(F.lit(folder).alias("folder"), F.to_json(F.struct(*rows.columns)).alias("element"))
    elements.mapInPandas(_arrays, "n long").agg(F.sum("n")).collect()


def _layout(spark: SparkSession, folder: str) -> str:
    root = fresh_path(spark, "scenes")
    docs = table(spark, folder, "documents").where("source IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    stamp, zero = F.col("doc_id").alias("timestamp"), F.lit(0.0)
    langs = docs.select("lang").distinct()

    def named(prefix: str, column: str, name: str) -> Column:
        return F.concat(F.lit(prefix), F.col(column)).alias(name)

    upright, place = F.array(F.lit(1.0), zero, zero, zero).alias("rotation"), F.array(F.col("n_chars").cast("double"), zero, zero).alias("translation")
    files = {
        "scene": docs.select(F.col("source").alias("token"), named("scene-", "source", "name")).distinct(),
        "sample": docs.select(named("s", "doc_id", "token"), F.col("source").alias("scene_token"), stamp),
        "sample_data": docs.select(
            named("d", "doc_id", "token"), F.col("text").alias("note"), named("s", "doc_id", "sample_token"), named("e", "doc_id", "ego_pose_token"),
            named("c", "lang", "calibrated_sensor_token"), stamp, F.lit("jpg").alias("fileformat"), named("payload/", "doc_id", "filename"),
        ),
        "ego_pose": docs.select(named("e", "doc_id", "token"), stamp, upright, place),
        "calibrated_sensor": langs.select(
            named("c", "lang", "token"), named("m", "lang", "sensor_token"), upright, F.array(zero, zero, zero).alias("translation"),
            F.array(F.array(F.lit(5.0), zero, F.lit(7.0))).alias("camera_intrinsic"),
        ),
        "sensor": langs.select(named("m", "lang", "token"), F.upper("lang").alias("channel"), F.when(F.col("lang") == "en", "lidar").otherwise("camera").alias("modality")),
        "sample_annotation": docs.select(
            named("s", "doc_id", "sample_token"), named("i", "lang", "instance_token"), upright, place,
            F.array(F.lit(1.0), F.lit(2.0), F.col("n_chars").cast("double")).alias("size"), F.col("doc_id").alias("num_lidar_pts"),
        ),
        "instance": langs.select(named("i", "lang", "token"), named("k", "lang", "category_token")),
        "category": langs.select(named("k", "lang", "token"), F.col("lang").alias("name")),
    }
    for name, rows in files.items():
        _write_arrays(rows, f"{root}/{name}.json")
    payloads = docs.select(F.concat(F.lit(f"{root}/payload/"), "doc_id").alias("path"), "text")
    payloads.mapInPandas(_payloads, "n long").agg(F.sum("n")).collect()
    return root


@query("SELECT doc_id, lang, source, n_chars, sha256(text) AS checksum FROM documents")
def json_array_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents through JSON arrays that are cut at any byte."""
    path = fresh_path(spark, "array")
    _write_arrays(table(spark, folder, "documents"), path)
    rows, _ = read_array(spark, path, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT", _SPLIT)
    return rows.select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("checksum"))


@query(
    """SELECT 'scene-' || source AS log_id, CASE lang WHEN 'en' THEN 'lidar' ELSE lang END AS sensor, 1000 * doc_id AS timestamp_ns,
  CAST(strlen(text) AS BIGINT) AS byte_size, sha256(text) AS checksum, 'jpg' AS codec,
  CASE lang WHEN 'en' THEN NULL ELSE 'scene-' || source || '/c' || lang END AS calibration_id FROM documents"""
)
def ingested_scene_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of the second layout after their ingest, with size and checksum of their payloads."""
    store, root = ParquetStore(spark, fresh_path(spark, "lake")), _layout(spark, folder)
    ingest_scenes(store, root, "v1", _SPLIT)
    return active_rows(store, "sensor_data").select("log_id", "sensor", "timestamp_ns", "byte_size", "checksum", "codec", "calibration_id")


@query(
    """SELECT 'scene-' || source AS log_id, count(*) AS source_total, count(*) AS table_total, 'ok' AS status, 1 AS n_commits, 'unchanged' AS action
FROM documents GROUP BY source"""
)
def scene_ingest_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The same gate and ledger as for logs: all frames there, one commit per scene, and a second ingest changes nothing."""
    store, root = ParquetStore(spark, fresh_path(spark, "lake")), _layout(spark, folder)
    ingest_scenes(store, root, "v1", _SPLIT)
    again = ingest_scenes(store, root, "v1", _SPLIT).logs.select("log_id", "action")
    commits = ledgers.commit_ids(store.read("sensor_data")).groupBy("log_id").agg(F.count("*").cast("int").alias("n_commits"))
    checked = reconcile_scenes(store, root).select("log_id", "source_total", "table_total", "status")
    return checked.join(commits, "log_id").join(again, "log_id")
