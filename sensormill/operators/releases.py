"""Releases: a pin of table contents, blobs and versions that either loads identically or is refused."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormill.functions.canonical import fingerprint
from sensormill.operators.blobs import verify
from sensormill.operators.joins import join_null_safe, last_per_key

BOOKKEEPING = ("ingest_commit_id", "ingested_at", "append_id")


def scoped(df: DataFrame, ignore: Sequence[str] = BOOKKEEPING) -> list[str]:
    """Columns that count as content: run identifiers do not."""
    return [c for c in df.columns if c not in ignore]


def pin_tables(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows and content fingerprint of each table."""
    pins = [
        fingerprint(df, list((columns or {}).get(name, scoped(df)))).select(F.lit(name).alias("table_name"), "n_rows", "fingerprint")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, pins)


def pin_blobs(sensor_data: DataFrame) -> DataFrame:
    return sensor_data.select("source_path", "byte_size", "checksum").distinct()


def changed_tables(pinned: DataFrame, current: DataFrame) -> DataFrame:
    """Tables whose content differs from the pin, or that exist on one side only."""
    now = current.select(
        "table_name", F.col("n_rows").alias("rows_now"), F.col("fingerprint").alias("fingerprint_now")
    )
    return pinned.join(now, "table_name", "full").where(
        ~F.col("fingerprint").eqNullSafe(F.col("fingerprint_now"))
    )


def changed_blobs(pinned: DataFrame, listing: DataFrame) -> DataFrame:
    return verify(pinned, listing).where(F.col("outcome") != "ok")


def newest_states(events: DataFrame, key: str = "release_id", version: str = "version") -> DataFrame:
    """Current state per release: order by version, whatever order the events arrived in."""
    return last_per_key(events, [key], [version])


def stale_events(events: DataFrame, held: DataFrame, key: str = "release_id", version: str = "version") -> DataFrame:
    """Events not newer than the state a consumer already holds."""
    known = held.select(key, F.col(version).alias("_held"))
    return join_null_safe(events, known, [key], "left").where(F.col(version) <= F.col("_held")).drop("_held")


def consistent_samples(
    rows: DataFrame, sample: Sequence[str], required: Sequence[str], allow_missing: int = 0, sensor: str = "sensor"
) -> DataFrame:
    """Samples holding the required sensors, up to ``allow_missing`` absent ones.

    Each required sensor is one flag per sample, so a sample of any size shrinks to one row before the shuffle.
    """
    flags = [F.max(F.when(F.col(sensor) == s, 1).otherwise(0)) for s in required]
    present = reduce(lambda a, b: a + b, flags)
    return (
        rows.groupBy(*sample)
        .agg(F.count(F.lit(1)).alias("n_rows"), present.alias("n_required"))
        .where(F.col("n_required") >= len(required) - allow_missing)
    )


def consistent_calibration(rows: DataFrame, sample: Sequence[str], calibration: str = "calibration_id") -> DataFrame:
    """Samples whose rows agree on one calibration version per sensor."""
    per_sensor = rows.groupBy(*sample, "sensor").agg(
        F.min(calibration).alias("_low"), F.max(calibration).alias("_high")
    )
    return (
        per_sensor.groupBy(*sample)
        .agg(F.sum(F.when(F.col("_low").eqNullSafe(F.col("_high")), 0).otherwise(1)).alias("_mixed"))
        .where("_mixed = 0")
        .select(*sample)
    )


def usable_samples(
    rows: DataFrame,
    sample: Sequence[str],
    required: Sequence[str],
    always: Sequence[str],
    calibrations: DataFrame,
    blobs: DataFrame,
    allow_missing: int = 0,
) -> DataFrame:
    """Samples that meet all four conditions of a slice, and why the others do not.

    * sensors: every sensor of ``required`` is there, but for ``allow_missing`` of them;
    * policy of missing frames: those of ``always`` are never missing;
    * calibration: a sensor counts only if all its rows carry the version that ``calibrations`` (sensor, calibration_id)
      names; a sensor it does not list needs none;
    * blobs: a sensor counts only if the payloads of all its rows are in ``blobs`` (source_path).

    Rows have the sample, sensor, calibration_id and source_path. Each condition is a set of sensors kept as bits, so a
    sample is one row of three numbers after one aggregation. At most 63 required sensors.
    """
    if len(required) > 63 or not set(always) <= set(required):
        raise ValueError("at most 63 required sensors, and those that are always needed among them")
    bit = F.coalesce(*(F.when(F.col("sensor") == s, F.lit(1 << i)) for i, s in enumerate(required))).cast("bigint")
    wanted = calibrations.select("sensor", F.col("calibration_id").alias("_wanted"), F.lit(True).alias("_listed"))
    there = blobs.select("source_path", F.lit(True).alias("_there")).distinct()
    marked = rows.withColumn("_bit", bit).where(F.col("_bit").isNotNull())
    marked = join_null_safe(marked, wanted, ["sensor"], "left").join(there, "source_path", "left")
    wrong = F.col("_listed").isNotNull() & ~F.col("calibration_id").eqNullSafe(F.col("_wanted"))
    nothing = F.lit(0).cast("bigint")
    sets = marked.groupBy(*sample).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_or("_bit").alias("present"),
        F.bit_or(F.when(wrong, F.col("_bit")).otherwise(nothing)).alias("miscalibrated"),
        F.bit_or(F.when(F.col("_there").isNull(), F.col("_bit")).otherwise(nothing)).alias("without_blob"),
    )
    unusable = F.col("miscalibrated").bitwiseOR(F.col("without_blob"))
    usable = F.col("present").bitwiseAND(F.bitwise_not(unusable))
    needed = F.lit(sum(1 << required.index(s) for s in always)).cast("bigint")
    n_usable = F.bit_count(usable)
    complete = (n_usable >= len(required) - allow_missing) & (usable.bitwiseAND(needed) == needed)
    return sets.select(*sample, "n_rows", "present", "miscalibrated", "without_blob", n_usable.cast("int").alias("n_usable"), complete.alias("usable"))


def backfill_work(units: DataFrame, slice_: Column, done: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Units of the slice that are not done yet."""
    return units.where(slice_).select(*ids).distinct().join(done.select(*ids), list(ids), "left_anti")
