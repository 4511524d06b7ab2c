"""Reconciliation of stored logs with keys taken from the source folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.functions.text import format_number
from sensormill.operators import ledger as ledgers
from sensormill.operators.multiset import compare, summarise
from sensormill.sources.keys import source_keys


def active_rows(store, table: str, log_ids: DataFrame | None = None) -> DataFrame:
    """Rows of ``table`` a reader may see: those of each log's active commit."""
    active = ledgers.latest(ledgers.activations(store.ledger()))
    if log_ids is not None:
        active = active.join(log_ids.select("log_id").distinct(), "log_id", "left_semi")
    return commit_rows(store, table, active)


def commit_rows(store, table: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` that belong to the commits ``wanted`` (log_id, commit_id)."""
    if not hasattr(store, "read_appends"):
        return ledgers.visible(store.read(table), wanted)
    # The ledger knows which append brought a commit's rows: only those folders are opened.
    brought = ledgers.commits(store.ledger()).select("log_id", "commit_id", F.col("committed_seq").alias("append_id"))
    keep = wanted.select("log_id", "commit_id").join(brought, ["log_id", "commit_id"]).withColumnRenamed("commit_id", "ingest_commit_id")
    moves = store.moves(table)
    if moves is not None:
        placed = keep.join(moves, F.col("append_id") == F.col("from_append"), "left")
        keep = placed.select("log_id", "ingest_commit_id", F.coalesce("to_append", "append_id").alias("append_id"))
    appends = [r[0] for r in keep.select("append_id").distinct().collect()]  # at most one per batch of ingest
    rows = store.read_appends(table).where(F.col("append_id").isin(appends))
    return rows.join(keep, ["append_id", "log_id", "ingest_commit_id"], "left_semi").select(*store.schemas[table].fieldNames())


def reconcile_keys(store, folders: DataFrame) -> DataFrame:
    """Per key: source and table counts, missing, extra and duplicate."""
    return compare(source_keys(folders), active_rows(store, "sensor_data", folders))


def reconcile(store, folders: DataFrame) -> DataFrame:
    """One row per log of ``folders`` with status, figures and the report line. ``passed`` holds only if all is there.

    Status is ``not_ingested``, ``empty_source``, ``incomplete``, ``surplus`` or ``ok``.
    """
    figures = summarise(reconcile_keys(store, folders))
    active = ledgers.latest(ledgers.activations(store.ledger()))
    joined = folders.select("log_id").distinct().join(active, "log_id", "left").join(figures, "log_id", "left")
    status = F.when(F.col("commit_id").isNull(), "not_ingested").otherwise(F.coalesce("status", F.lit("empty_source")))
    rows = joined.withColumn("status", status).withColumn("passed", F.col("status") == "ok")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("source_total", "table_total", "missing", "extra", "duplicate")}
    rows = rows.withColumns(counts)
    line = F.when(F.col("status") == "not_ingested", F.concat("log_id", F.lit(" not ingested"))).otherwise(
        F.concat(
            "log_id",
            F.lit(" commit="),
            "commit_id",
            F.lit(" completeness="),
            F.coalesce(format_number(F.col("completeness"), ".6%"), F.lit("none")),
            F.lit(" missing="),
            F.col("missing").cast("string"),
            F.lit(" extra="),
            F.col("extra").cast("string"),
            F.lit(" duplicate="),
            F.col("duplicate").cast("string"),
        )
    )
    return rows.withColumn("line", line)
