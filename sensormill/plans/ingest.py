"""Ingest of many logs as one job family: hash once, decide against the ledger, write data, then the ledger."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.functions.canonical import digest_by
from sensormill.operators import ledger as ledgers
from sensormill.operators.integrity import split_log_ids
from sensormill.operators.normalise import WRITE_ORDER, canonical_tables, unreadable_stamps, without_required_files
from sensormill.plans.store import next_snapshot_id
from sensormill.sources.files import digest_items, hash_files, list_files, tasks_for
from sensormill.workspace import materialise

# Fixed value: SHA-256 of no bytes, the digest of a folder without files.
EMPTY_DIGEST = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@dataclass(frozen=True)
class Ingested:
    logs: DataFrame  # log_id, commit_id, action: committed, reactivated, unchanged or refused
    rows_written: dict[str, int]
    quarantined: int = 0  # rows this run added to the store's quarantine


def source_digests(folders: DataFrame, hashed: DataFrame) -> DataFrame:
    """(log_id, root, source_digest) over every file of each folder, whatever its name."""
    found = digest_by(digest_items(hashed), ["log_id"], "item", "source_digest")
    return folders.select("log_id", "root").join(found, "log_id", "left").withColumn(
        "source_digest", F.coalesce("source_digest", F.lit(EMPTY_DIGEST))
    )


def _commit_id(run: str):
    """An id per log of this run. It is computed from the run's id, so a task that runs again finds the same one."""
    h = F.md5(F.concat(F.lit(run + "|"), F.col("log_id")))
    return F.concat_ws(
        "-", *(F.substring(h, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    )


def plan_commits(folders: DataFrame, hashed: DataFrame, ledger: DataFrame, transform_version: str, run: str) -> DataFrame:
    """Each log with the commit its source state has, or a fresh commit id (``is_new``)."""
    candidates = source_digests(folders, hashed).withColumn("transform_version", F.lit(transform_version))
    found = ledgers.find_commits(candidates, ledgers.commits(ledger))
    return found.withColumns(
        {"is_new": F.col("commit_id").isNull(), "commit_id": F.coalesce("commit_id", _commit_id(run))}
    )


def write_tables(store, logs: DataFrame, hashed: DataFrame, append_id: int, fill_digest: bool = False) -> dict[str, int]:
    """Append the five tables of ``logs``; nothing is visible until the ledger says so."""
    return {
        name: store.append(name, rows, append_id)
        for name, rows in canonical_tables(logs, hashed, fill_digest).items()
    }


def record(store, logs: DataFrame, append_id: int, written: dict[str, int]) -> DataFrame:
    """Append commits and activations for ``logs`` whose commit is not the active one; returns those logs.

    The snapshot of a table is this append if it got rows, else the one the ledger knew before.
    """
    ledger = store.ledger()
    active = ledgers.latest(ledgers.activations(ledger))
    changed = logs.join(ledgers.changed_activations(logs, active), ["log_id", "commit_id"], "left_semi")
    known = {r.table_name: r.snapshot_id for r in ledgers.recorded_snapshots(ledger).collect()}
    snapshots = {t: store.snapshot_of(t, append_id) if n else known.get(t) for t, n in written.items()}
    entries = [x for t, s in snapshots.items() for x in (F.lit(t), F.lit(s).cast("bigint"))]
    rows = changed.select(
        F.lit(append_id).cast("bigint").alias("seq"),
        *ledgers.IDENTITY,
        "commit_id",
        F.create_map(*entries).alias("snapshots"),
        F.current_timestamp().alias("recorded_at"),
    )
    kept = materialise(rows, "ledger-rows")
    store.append_ledger(kept, append_id)
    return kept


def ingest(store, folders: DataFrame, transform_version: str, fill_digest: bool = False) -> Ingested:
    """Bring every log of ``folders`` (log_id, root) to its current source state.

    A state seen before is re-activated without new rows. A log with an improper id, with more than one root, or without
    one of its table files, is refused and leaves the others alone. What is refused, and sensor files whose stamp does
    not fit, goes to the store's quarantine with its reason. Files are read once: the hash serves the digest and the table.
    """
    run, append_id = uuid.uuid4().hex, next_snapshot_id()
    store.ensure_tables()
    trimmed = folders.select("log_id", F.regexp_replace("root", "(?<=[^/:])/+$", "").alias("root")).distinct()
    named, improper = split_log_ids(trimmed)
    several = named.groupBy("log_id").agg(F.count("root").alias("n"), F.concat_ws(", ", F.sort_array(F.collect_set("root"))).alias("detail")).where("n > 1")
    several = materialise(several.drop("n"), "several-roots")
    named = named.join(several, "log_id", "left_anti")
    listed = materialise(list_files(named), "listed-files")
    hashed = materialise(hash_files(listed, tasks_for(listed)), "hashed-files")
    lacking = materialise(without_required_files(named, hashed), "lacking-files")
    broken = lacking.select("log_id").distinct()
    usable = named.join(broken, "log_id", "left_anti")
    planned = materialise(plan_commits(usable, hashed, store.ledger(), transform_version, run), "planned-commits")
    fresh = planned.where("is_new")
    written = dict.fromkeys(WRITE_ORDER, 0)
    if not fresh.isEmpty():
        written = write_tables(store, fresh, hashed, append_id, fill_digest)
    recorded = record(store, planned, append_id, written).select("log_id", F.lit(True).alias("_recorded"))
    action = (
        F.when(F.col("is_new"), "committed")
        .when(F.col("_recorded"), "reactivated")
        .otherwise("unchanged")
    )
    done = planned.join(recorded, "log_id", "left").select("log_id", "commit_id", action.alias("action"))
    refused = improper.select("log_id").distinct().unionByName(several.select("log_id")).unionByName(broken).select(
        "log_id", F.lit(None).cast("string").alias("commit_id"), F.lit("refused").alias("action")
    )
    reasons = (
        _reason(improper, "root", "improper_log_id")
        .unionByName(_reason(several, "log_id", "several_roots", "detail"))
        .unionByName(_reason(lacking, "file", "file_missing"))
        .unionByName(_reason(unreadable_stamps(hashed).join(fresh, "log_id"), "source_path", "stamp_too_long", "stamp", "commit_id"))
    )
    held = materialise(reasons, "quarantine")
    quarantined = held.count()
    if quarantined:
        store.append_quarantine(held, append_id)
    return Ingested(done.unionByName(refused), written, quarantined)


def _reason(rows: DataFrame, what: str, reason: str, detail: str | None = None, commit: str | None = None) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return rows.select(
        "log_id",
        F.col(what).alias("object"),
        F.lit(reason).alias("reason"),
        (F.col(detail) if detail else nothing).alias("detail"),
        (F.col(commit) if commit else nothing).alias("commit_id"),
    )
