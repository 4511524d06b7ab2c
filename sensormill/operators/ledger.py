"""Commit ledger: which commit of a log is current, and which rows readers may see.

The ledger is append-only. One row records both a commit and its activation, so the two become visible together; a
row repeating an earlier commit is a re-activation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDENTITY = ("log_id", "source_digest", "transform_version")


def commits(ledger: DataFrame) -> DataFrame:
    """One row per identity. If two writers raced, the earlier row wins and the other commit stays invisible."""
    return ledger.groupBy(*IDENTITY).agg(
        F.min_by("commit_id", F.struct("seq", "commit_id")).alias("commit_id"),
        F.min("seq").alias("committed_seq"),
    )


def activations(ledger: DataFrame) -> DataFrame:
    """All activations in order, each pointing to the winning commit of its identity."""
    winners = commits(ledger).select(*IDENTITY, "commit_id")
    return ledger.select("seq", *IDENTITY).join(winners, list(IDENTITY)).select("seq", "log_id", "commit_id")


def latest(activated: DataFrame, as_of: int | None = None) -> DataFrame:
    """The commit activated last per log, optionally as it was at ledger position ``as_of``."""
    seen = activated if as_of is None else activated.where(F.col("seq") <= as_of)
    return seen.groupBy("log_id").agg(F.max_by("commit_id", F.struct("seq", "commit_id")).alias("commit_id"))


def visible(rows: DataFrame, active: DataFrame) -> DataFrame:
    """Rows of the active commit of their log."""
    keep = active.select("log_id", F.col("commit_id").alias("ingest_commit_id"))
    return rows.join(keep, ["log_id", "ingest_commit_id"], "left_semi")


def uncommitted(rows: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows whose commit never reached the ledger, such as those of a job that died between two tables."""
    known = committed.select(F.col("commit_id").alias("ingest_commit_id"))
    return rows.join(known, "ingest_commit_id", "left_anti")


def find_commits(candidates: DataFrame, committed: DataFrame) -> DataFrame:
    """Candidates with the commit id their identity already has, or NULL."""
    return candidates.join(committed.select(*IDENTITY, "commit_id"), list(IDENTITY), "left")


def new_commits(candidates: DataFrame, committed: DataFrame) -> DataFrame:
    """Candidates whose identity is not in the ledger yet; repeated candidates keep the first commit id."""
    unseen = candidates.join(committed, list(IDENTITY), "left_anti")
    return unseen.groupBy(*IDENTITY).agg(F.min("commit_id").alias("commit_id"))


def changed_activations(candidates: DataFrame, active: DataFrame) -> DataFrame:
    """Candidates (log_id, commit_id) that are not already the active commit of their log."""
    current = active.select("log_id", F.col("commit_id").alias("_current"))
    return (
        candidates.select("log_id", "commit_id")
        .join(current, "log_id", "left")
        .where(~F.col("commit_id").eqNullSafe(F.col("_current")))
        .drop("_current")
    )


def commit_ids(rows: DataFrame, by: Sequence[str] = ("log_id",)) -> DataFrame:
    return rows.select(*by, "ingest_commit_id").distinct()


def commit_id_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per side combination, how many commit ids: only left, only right, in both."""
    tagged = left.select("ingest_commit_id", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select("ingest_commit_id", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sides = tagged.groupBy("ingest_commit_id").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    where = F.when(F.col("_r") == 0, "left_only").when(F.col("_l") == 0, "right_only").otherwise("both")
    return sides.groupBy(where.alias("membership")).agg(F.count(F.lit(1)).alias("n_commits"))


def recorded_snapshots(ledger: DataFrame) -> DataFrame:
    """(table_name, snapshot_id) as of the newest ledger rows: no table has to be opened for it."""
    entries = ledger.select(F.explode("snapshots").alias("table_name", "snapshot_id"))
    return entries.groupBy("table_name").agg(F.max("snapshot_id").alias("snapshot_id"))


def export_commits(ledger: DataFrame) -> DataFrame:
    """Ledger rows with the snapshot map as JSON text."""
    return ledger.withColumn("snapshots", F.to_json("snapshots"))
