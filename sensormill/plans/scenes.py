"""Ingest of the second dataset layout under the same ledger: a scene is a log, with digest, checksums and one commit.

The files of this layout hold rows of all scenes, so a scene has no folder whose bytes could be its digest. Its source
state is the digest of its canonical rows and of the payload files they name; a scene whose rows and payloads are as
before keeps its commit, whatever else changed in the files.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.functions.canonical import digest_by, row_hash
from sensormill.operators import ledger as ledgers
from sensormill.operators.integrity import split_log_ids
from sensormill.operators.releases import scoped
from sensormill.operators.multiset import compare, summarise
from sensormill.plans.ingest import EMPTY_DIGEST, Ingested, _commit_id, _reason, record
from sensormill.plans.reconcile import active_rows
from sensormill.plans.store import next_snapshot_id
from sensormill.sources.files import probe_files
from sensormill.sources.json_arrays import SPLIT
from sensormill.sources.json_scenes import canonical_scenes, read_scenes
from sensormill.sources.keys import scene_keys
from sensormill.workspace import materialise


def scene_tables(spark, root: str, split: int = SPLIT) -> dict[str, DataFrame]:
    """The canonical tables of all scenes, with size and checksum of every payload that is there."""
    tables = canonical_scenes(read_scenes(spark, root, split), "")
    at = F.concat(F.lit(root.rstrip("/") + "/"), F.col("source_path"))
    rows = materialise(tables["sensor_data"].withColumn("source_path", at), "scene-rows")
    found = probe_files(rows.select("source_path").distinct())
    sized = rows.drop("byte_size", "checksum").join(found.hint("merge"), "source_path", "left")  # a row per payload: never broadcast
    tables["sensor_data"] = sized.select(*rows.columns)
    return {name: materialise(table, f"scene-table-{name}") for name, table in tables.items()}


def scene_digests(tables: dict[str, DataFrame]) -> DataFrame:
    """(log_id, source_digest) over the rows of all tables; the checksum of a payload is part of its row."""
    items = [
        rows.select("log_id", F.concat(F.lit(f"{name}|"), row_hash(rows, scoped(rows))).alias("item")) for name, rows in sorted(tables.items())
    ]
    return digest_by(reduce(DataFrame.unionByName, items), ["log_id"], "item", "source_digest")


def ingest_scenes(store, root: str, transform_version: str, split: int = SPLIT) -> Ingested:
    """Bring every scene below ``root`` to its current source state, as ``ingest`` does with log folders.

    Scenes with an improper name, and scenes with a payload that is not there, are refused and go to quarantine.
    """
    spark, run, append_id = store.spark, uuid.uuid4().hex, next_snapshot_id()
    store.ensure_tables()
    tables = scene_tables(spark, root, split)
    scenes = tables["log"].select("log_id").distinct()
    named, improper = split_log_ids(scenes)
    lacking = materialise(tables["sensor_data"].where("checksum IS NULL").select("log_id", "source_path").distinct(), "scene-lacking")
    usable = named.join(lacking.select("log_id").distinct(), "log_id", "left_anti")
    states = usable.join(scene_digests(tables), "log_id", "left").withColumns({
        "source_digest": F.coalesce("source_digest", F.lit(EMPTY_DIGEST)), "transform_version": F.lit(transform_version),
    })
    found = ledgers.find_commits(states, ledgers.commits(store.ledger()))
    marked = {"is_new": F.col("commit_id").isNull(), "commit_id": F.coalesce("commit_id", _commit_id(run))}
    planned = materialise(found.withColumns(marked), "planned-scenes")
    fresh = planned.where("is_new").select("log_id", F.col("commit_id").alias("ingest_commit_id"))
    written = dict.fromkeys(tables, 0)
    if not fresh.isEmpty():
        written = {name: store.append(name, rows.drop("ingest_commit_id").join(fresh, "log_id"), append_id) for name, rows in tables.items()}
    recorded = record(store, planned, append_id, written).select("log_id", F.lit(True).alias("_recorded"))
    action = F.when(F.col("is_new"), "committed").when(F.col("_recorded"), "reactivated").otherwise("unchanged")
    done = planned.join(recorded, "log_id", "left").select("log_id", "commit_id", action.alias("action"))
    refused = improper.select("log_id").unionByName(lacking.select("log_id")).distinct().select(
        "log_id", F.lit(None).cast("string").alias("commit_id"), F.lit("refused").alias("action")
    )
    reasons = _reason(improper, "log_id", "improper_log_id").unionByName(_reason(lacking, "source_path", "file_missing"))
    held = materialise(reasons, "quarantine")
    quarantined = held.count()
    if quarantined:
        store.append_quarantine(held, append_id)
    return Ingested(done.unionByName(refused), written, quarantined)


def reconcile_scenes(store, root: str) -> DataFrame:
    """One row per scene: its frames in the source against those of its active commit."""
    return summarise(compare(scene_keys(store.spark, root), active_rows(store, "sensor_data")))
