"""Nearest-frame joins in both directions; a tie goes to the earlier frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormill.functions.text import format_number
from sensormill.functions.timing import ns_to_ms
from sensormill.operators.ordered import BIN, binned, distribution, scan_bins

SWEEP, FRAME = 1, 2


def _for_each_camera(rows: DataFrame, cameras: DataFrame | Sequence[str]) -> DataFrame:
    """Rows once per camera: of a fixed list, or of the cameras (log_id, sensor) their log has."""
    if isinstance(cameras, DataFrame):
        return rows.join(cameras.select("log_id", "sensor"), "log_id")
    return rows.withColumn("sensor", F.explode(F.array(*(F.lit(c) for c in cameras))))


def _borrowed_frames(points: DataFrame, key: Sequence[str], frame: Column) -> DataFrame:
    """For each bin the last frame of the bins before it and the first of those after it."""
    bins = points.groupBy(*key, BIN).agg(F.max(frame).alias("_last"), F.min(frame).alias("_first"))
    outside = scan_bins(bins, key, {"_before": ("_last", "max", "before"), "_after": ("_first", "min", "after")})
    stamp = F.explode(F.array_compact(F.array("_before", "_after"))).alias("timestamp_ns")
    return outside.select(*key, BIN, stamp, F.lit(FRAME).alias("_kind"))


def nearest_frames(
    sweeps: DataFrame, frames: DataFrame, cameras: DataFrame | Sequence[str], bin_ns: float | None = None
) -> DataFrame:
    """The nearest frame of every camera for every distinct sweep (log_id, timestamp_ns).

    Sweeps and frames are merged on one time line per camera and cut into bins, of like size without ``bin_ns``. Inside a bin the last frame at or before and the first at or after a sweep are running
    maxima and minima; of other bins it borrows the last frame before and the first after. The work is linear in rows
    plus one sort, however long a log is. A camera without frames keeps its rows, with NULL for the frame.
    """
    key = ["log_id", "sensor"]
    targets = _for_each_camera(sweeps.select("log_id", "timestamp_ns"), cameras)
    line = targets.select(*key, "timestamp_ns", F.lit(SWEEP).alias("_kind")).unionByName(
        frames.select(*key, "timestamp_ns", F.lit(FRAME).alias("_kind"))
    )
    # One column for both marks: whoever reads the merged line reads the same columns, so its shuffle is done once.
    marked = line.groupBy(*key, "timestamp_ns").agg(F.bit_or("_kind").alias("_kind"))
    points = binned(marked, key, ["timestamp_ns"], bin_ns)
    frame = F.when(F.col("_kind").bitwiseAND(FRAME) != 0, F.col("timestamp_ns"))
    points = points.unionByName(_borrowed_frames(points, key, frame))
    inside = Window.partitionBy(*key, BIN)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    before, after, sweep = F.col("_before"), F.col("_after"), F.col("timestamp_ns")
    ahead, behind = (F.try_subtract(a, b) for a, b in ((after, sweep), (sweep, before)))  # NULL: beyond 64 bits, far
    nearer = ahead.isNotNull() & (behind.isNull() | (ahead < behind))
    chosen = F.when(before.isNull(), after).when(after.isNotNull() & nearer, after).otherwise(before)
    return (
        points.withColumn("_frame", frame)
        .withColumn("_before", F.max("_frame").over(inside.orderBy("timestamp_ns").rowsBetween(*so_far)))
        .withColumn("_after", F.min("_frame").over(inside.orderBy(F.desc("timestamp_ns")).rowsBetween(*so_far)))
        .where(F.col("_kind").bitwiseAND(SWEEP) != 0)
        .select(*key, sweep.alias("sweep_ns"), chosen.alias("frame_ns"))
        .withColumn("skew_ns", F.try_subtract("frame_ns", "sweep_ns"))
        .withColumn("skew_ms", ns_to_ms(F.col("skew_ns")))
    )


def nearest_to_one_sweep(
    sweeps: DataFrame, frames: DataFrame, cameras: DataFrame | Sequence[str]
) -> DataFrame:
    """The same for exactly one sweep per log: one combining aggregation, no sort."""
    key = ["log_id", "sensor"]
    target = sweeps.select("log_id", F.col("timestamp_ns").alias("sweep_ns"))
    distance = F.abs(F.col("timestamp_ns") - F.col("sweep_ns"))
    best = (
        frames.join(target, "log_id")
        .groupBy(*key)
        .agg(F.min_by("timestamp_ns", F.struct(distance, F.col("timestamp_ns"))).alias("frame_ns"))
    )
    skew = F.col("frame_ns") - F.col("sweep_ns")
    return (
        _for_each_camera(target, cameras)
        .join(best, key, "left")
        .select(*key, "sweep_ns", "frame_ns", skew.alias("skew_ns"), ns_to_ms(skew).alias("skew_ms"))
    )


def skew_distribution(
    skews: DataFrame, by: Sequence[str] = ("log_id", "sensor"), percents: Sequence[int] = (5, 50, 95)
) -> DataFrame:
    """Minimum, exact percentiles, maximum and sweeps without any frame, per camera."""
    spread = distribution(skews, by, "skew_ns", percents)
    return spread.select(
        *by,
        (F.col("n") + F.col("n_null")).alias("n_sweeps"),
        F.col("n_null").alias("n_without_frame"),
        F.col("min").alias("min_ns"),
        F.col("max").alias("max_ns"),
        *(f"p{p}" for p in percents),
    )


def skew_report(skews: DataFrame) -> DataFrame:
    return skews.select("log_id", "sensor", format_number(F.col("skew_ms"), "+.2f", " ms").alias("skew"))
