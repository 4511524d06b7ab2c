"""The table of sensor checks: one row per measured value, with the version of the check that measured it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.operators.sweeps import sweep_stats
from sensormill.workspace import materialise

TABLE = "sweep_stat"
DDL = "log_id STRING, sensor STRING, sweep_ns BIGINT, metric STRING, value DOUBLE, check_version STRING"
IDS = ("log_id", "sensor", "sweep_ns")


def record(store, measured: Mapping[str, tuple[DataFrame, Sequence[str]]], append_id: int) -> int:
    """Append the metrics of all checks at once. ``measured`` maps a version, such as ``pose-2``, to the measurements and
    the columns of them that are metrics. Measurements that are about no sensor or sweep have NULL there."""
    rows = []
    for version, (df, metrics) in measured.items():
        absent = {c: F.lit(None).cast("bigint" if c == "sweep_ns" else "string") for c in IDS if c not in df.columns}
        rows.append(sweep_stats(df.withColumns(absent), metrics, version, IDS))
    return store.append(TABLE, reduce(DataFrame.unionByName, rows), append_id)


def current(store) -> DataFrame:
    """Of every check only what its newest version says of a log, and of that version what was recorded last.

    A version is a name, a dash and a number. A newer version replaces an older one log by log, whatever metrics it has.
    """
    rows = store.read_appends(TABLE)
    parts = {
        "_check": F.regexp_extract("check_version", "^(.*)-[0-9]+$", 1),
        "_number": F.regexp_extract("check_version", "-([0-9]+)$", 1).try_cast("bigint"),
    }
    # What is newest is a matter of logs, versions and appends: few beside the rows.
    seen = materialise(rows.select("log_id", "check_version", "append_id").distinct().withColumns(parts), "recorded-versions")
    newest = seen.groupBy("log_id", "_check").agg(F.max(F.struct("_number", "append_id")).alias("_top"))
    newest = newest.select("log_id", "_check", F.col("_top._number").alias("_number"), F.col("_top.append_id").alias("append_id"))
    chosen = seen.join(newest, ["log_id", "_check", "_number", "append_id"], "left_semi").select("log_id", "check_version", "append_id")
    kept = rows.join(chosen, ["log_id", "check_version", "append_id"], "left_semi")
    # All that is left of a key came with one append; of a key that came twice with it the greater value stays.
    keys = [*IDS, "metric", "check_version"]
    return kept.groupBy(*keys).agg(F.max("value").alias("value")).select(*IDS, "metric", "value", "check_version")
