"""Sensor-level checks. Each yields measurements, and ``sweep_stats`` stacks them as rows rather than booleans.

Point tables have log_id, sweep_ns, row_index (recorded order), x, y, z, laser_number, offset_ns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormill.operators.ordered import bin_of, distribution, quantiles, with_position, with_previous, with_running_sums
from sensormill.workspace import materialise

SWEEP = ("log_id", "sweep_ns")
ROWS_PER_BLOCK = 4096


def laser_returns(
    points: DataFrame, keys: Sequence[str] = ("log_id", "laser_number"), sweep: str = "sweep_ns"
) -> DataFrame:
    return points.groupBy(*keys, sweep).agg(F.count(F.lit(1)).alias("n_returns"))


def returns_against_history(
    returns: DataFrame,
    history: int = 10,
    keys: Sequence[str] = ("log_id", "laser_number"),
    sweep: str = "sweep_ns",
    collapse_ratio: float = 0.5,
) -> DataFrame:
    """Each laser's count against the mean of its ``history`` preceding sweeps.

    The sweep table has one row per laser and sweep, already counted. The window is cut by blocks of sweeps so that a
    single laser is not one task: each row joins the block of its own and, for the first rows of a block, the tail of
    the block before it.
    """
    if history < 1:
        raise ValueError("history must be at least one sweep")
    numbered = with_position(returns, keys, sweep, name="_rn")
    block = max(ROWS_PER_BLOCK, history)
    home = F.floor(F.col("_rn") / block)
    # A row also serves as history for the next block if it is among the last `history` rows before it.
    spread = numbered.withColumn(
        "_block",
        F.explode(
            F.when(
                F.pmod(F.col("_rn"), F.lit(block)) >= block - history, F.array(home, home + 1)
            ).otherwise(F.array(home))
        ),
    ).withColumn("_own", F.col("_block") == home)
    past = Window.partitionBy(*keys, "_block").orderBy("_rn").rowsBetween(-history, -1)
    scored = spread.withColumns(
        {"history_n": F.count("n_returns").over(past), "history_sum": F.sum("n_returns").over(past)}
    ).where("_own")
    mean = F.when(F.col("history_n") > 0, F.col("history_sum") / F.col("history_n"))
    return scored.select(
        *keys,
        sweep,
        "n_returns",
        "history_n",
        "history_sum",
        mean.alias("history_mean"),
        F.coalesce(F.col("n_returns") < F.lit(collapse_ratio) * mean, F.lit(False)).alias("collapsed"),
    )


def returns_spread(
    returns: DataFrame,
    history: int = 10,
    keys: Sequence[str] = ("log_id", "laser_number"),
    sweep: str = "sweep_ns",
    limit: float = 3.0,
) -> DataFrame:
    """Each laser's count against mean and deviation of its ``history`` preceding sweeps, however many these are.

    Running sums of counts and of their squares, less the same sums ``history`` sweeps earlier: one join by position,
    and no window holds the history. ``deviating`` says that the count lies more than ``limit`` deviations off its mean;
    where all of the history is equal, that it differs at all. Sums are exact, so no order of rows shows in them.
    """
    if history < 1:
        raise ValueError("history must be at least one sweep")
    n = F.col("n_returns").cast("decimal(18,0)")
    counted = returns.withColumns({"_one": F.lit(1).cast("bigint"), "_n": n, "_nn": n * n})
    running = materialise(with_running_sums(counted, keys, [sweep], {"_at": "_one", "_s": "_n", "_q": "_nn"}).drop("_one"), "running-returns")
    earlier = running.select(
        *(F.col(k).alias(f"_e_{k}") for k in keys), (F.col("_at") + history + 1).alias("_e_at"), F.col("_s").alias("_es"), F.col("_q").alias("_eq")
    )
    same = F.col("_at") == F.col("_e_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
    none = F.lit(0).cast("decimal(38,0)")
    joined = running.join(earlier, same, "left").withColumns({
        "history_n": F.least(F.col("_at") - 1, F.lit(history)),
        "history_sum": (F.col("_s") - F.col("_n") - F.coalesce("_es", none)).cast("bigint"),
        "_squares": F.col("_q") - F.col("_nn") - F.coalesce("_eq", none),
    })
    count, total = F.nullif(F.col("history_n").cast("double"), F.lit(0.0)), F.col("history_sum").cast("double")
    # n * sum of squares - square of the sum is a whole number, so equal counts have a deviation of exactly 0.
    whole = (F.col("_squares") * F.col("history_n").cast("decimal(10,0)")).cast("double") - total * total
    scored = joined.withColumns({"history_mean": total / count, "history_std": F.sqrt(F.greatest(F.lit(0.0), whole)) / count})
    off = F.abs(F.col("n_returns") - F.col("history_mean")) > F.lit(limit) * F.col("history_std")
    return scored.select(*keys, sweep, "n_returns", "history_n", "history_mean", "history_std", F.coalesce(off, F.lit(False)).alias("deviating"))


def point_range(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)


def range_distribution(
    points: DataFrame, by: Sequence[str] = SWEEP, value: str = "range_m", bucket_m: float = 10.0
) -> DataFrame:
    """Points per range bucket. Counts combine before the shuffle; percentiles come from ``quantiles``."""
    return points.groupBy(*by, bin_of(F.col(value), bucket_m).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_points")
    )


def range_quantiles(
    points: DataFrame, by: Sequence[str] = SWEEP, value: str = "range_m", percents: Sequence[int] = (50, 95)
) -> DataFrame:
    return quantiles(points, by, value, percents)


def sweep_timing(
    points: DataFrame,
    keys: Sequence[str] = SWEEP,
    laser: str = "laser_number",
    order: str = "row_index",
    offset: str = "offset_ns",
    revolution_ns: int = 100_000_000,
    tolerance_ns: int = 5_000_000,
) -> DataFrame:
    """Span of the offsets of a sweep and how often an offset steps back within its laser, in recorded order."""
    stepped = with_previous(points, [*keys, laser], order, payload=[offset])
    back = F.col(offset) < F.col(f"previous.{offset}")
    span = F.max(offset) - F.min(offset)
    return stepped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        span.alias("span_ns"),
        F.sum(F.when(back, 1).otherwise(0)).alias("n_steps_back"),
        (F.abs(span - F.lit(revolution_ns)) <= tolerance_ns).alias("spans_revolution"),
    )


def pose_steps(poses: DataFrame, bin_ns: float | None = None, payload_ties: Sequence[str] = ()) -> DataFrame:
    """Time step, distance and turning angle between consecutive poses of a log."""
    quaternion = ("qw", "qx", "qy", "qz")
    place = ("tx_m", "ty_m", "tz_m")
    stepped = with_previous(
        poses, ["log_id"], "timestamp_ns", bin_ns, ties=payload_ties, payload=[*quaternion, *place]
    )
    dot = sum((F.col(q) * F.col(f"previous.{q}") for q in quaternion), F.lit(0.0))
    square = sum(((F.col(t) - F.col(f"previous.{t}")) ** 2 for t in place), F.lit(0.0))
    return stepped.withColumns(
        {
            "step_ns": F.col("timestamp_ns") - F.col("previous.timestamp_ns"),
            "distance_m": F.sqrt(square),
            "angle_rad": 2 * F.acos(F.least(F.lit(1.0), F.abs(dot))),
        }
    ).drop("previous")


def pose_continuity(
    steps: DataFrame, max_step_ns: int = 50_000_000, max_distance_m: float = 2.0, max_angle_rad: float = 0.2
) -> DataFrame:
    """Gaps and jumps per log. The limits are parameters of the policy, not facts about the data."""

    def hits(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).alias(name)

    return steps.groupBy("log_id").agg(
        F.count(F.lit(1)).alias("n_poses"),
        F.max("step_ns").alias("max_step_ns"),
        hits(F.col("step_ns") > max_step_ns, "n_gaps"),
        hits(F.col("distance_m") > max_distance_m, "n_jumps"),
        hits(F.col("angle_rad") > max_angle_rad, "n_turns"),
    )


def capture_intervals(
    stamps: DataFrame, keys: Sequence[str] = ("log_id", "sensor"), bin_ns: float | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    stepped = with_previous(stamps, keys, "timestamp_ns", bin_ns, ties=ties)
    return stepped.withColumn("interval_ns", F.col("timestamp_ns") - F.col("previous.timestamp_ns")).drop("previous")


def capture_rate(
    intervals: DataFrame,
    nominal_ns: Column,
    keys: Sequence[str] = ("log_id", "sensor"),
    percents: Sequence[int] = (50, 95),
    tolerance: float = 0.5,
) -> DataFrame:
    """Intervals per sensor against the nominal one: exact percentiles and how many are off by the tolerance.

    ``nominal_ns`` is a constant or an expression over ``keys``.
    """
    off = F.abs(F.col("interval_ns") - nominal_ns) > F.lit(tolerance) * nominal_ns
    extra = {"n_off_rate": F.sum(F.when(off, F.col("copies")).otherwise(0))}
    spread = distribution(intervals, keys, "interval_ns", percents, extra=extra)
    return spread.select(
        *keys,
        F.col("n").alias("n_intervals"),
        "n_off_rate",
        F.col("max").alias("max_interval_ns"),
        *(f"p{p}" for p in percents),
    )


def to_world(points: DataFrame, poses: DataFrame) -> DataFrame:
    """Ego-frame points in world coordinates: rotate by the pose's quaternion, then translate."""
    pose = poses.select("log_id", F.col("timestamp_ns").alias("sweep_ns"), "qw", "qx", "qy", "qz", "tx_m", "ty_m", "tz_m")
    return in_world(points.join(pose, ["log_id", "sweep_ns"]))


def in_world(posed: DataFrame) -> DataFrame:
    """The same for points that carry their pose: its columns become wx, wy, wz."""
    w, i, j, k = (F.col(q) for q in ("qw", "qx", "qy", "qz"))
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    rows = {
        "wx": (1 - 2 * (j * j + k * k)) * x + 2 * (i * j - k * w) * y + 2 * (i * k + j * w) * z + F.col("tx_m"),
        "wy": 2 * (i * j + k * w) * x + (1 - 2 * (i * i + k * k)) * y + 2 * (j * k - i * w) * z + F.col("ty_m"),
        "wz": 2 * (i * k - j * w) * x + 2 * (j * k + i * w) * y + (1 - 2 * (i * i + j * j)) * z + F.col("tz_m"),
    }
    return posed.withColumns(rows).drop("qw", "qx", "qy", "qz", "tx_m", "ty_m", "tz_m")


def ground_residuals(
    points: DataFrame,
    raster: DataFrame,
    by: Sequence[str] = SWEEP,
    cell_m: float = 0.3,
    region: Sequence[str] = ("log_id",),
) -> DataFrame:
    """Height of world points (wx, wy, wz) over the ground raster (cell_x, cell_y, height_m), per sweep.

    The raster is met through an equi-join on its cell, so neither side is broadcast by assumption.
    """
    cell = [*region, "cell_x", "cell_y"]
    z = F.col("wz")
    # Points of one cell and sweep become one row before anything is shuffled for the join.
    celled = (
        points.withColumns({"cell_x": bin_of(F.col("wx"), cell_m), "cell_y": bin_of(F.col("wy"), cell_m)})
        .groupBy(*dict.fromkeys([*by, *cell]))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(z).alias("_z"),
            F.sum(z * z).alias("_zz"),
            F.min(z).alias("_low"),
            F.max(z).alias("_high"),
        )
    )
    joined = celled.join(raster.select(*cell, F.col("height_m").alias("_h")), cell, "left")
    h, n = F.col("_h"), F.col("_n")
    on_raster = F.sum(F.when(h.isNotNull(), n).otherwise(0))
    return joined.groupBy(*by).agg(
        F.sum(n).alias("n_points"),
        on_raster.alias("n_on_raster"),
        (F.sum(F.col("_z") - n * h) / F.nullif(on_raster, F.lit(0))).alias("mean_m"),
        F.sqrt(
            F.greatest(F.lit(0.0), F.sum(F.col("_zz") - 2 * h * F.col("_z") + n * h * h))
            / F.nullif(on_raster, F.lit(0))
        ).alias("rms_m"),
        F.max(F.greatest(F.abs(F.col("_low") - h), F.abs(F.col("_high") - h))).alias("max_abs_m"),
    )


def sweep_stats(
    measured: DataFrame, metrics: Sequence[str], check_version: str, id_columns: Sequence[str] = ("log_id", "sensor", "sweep_ns")
) -> DataFrame:
    """Wide measurements as (ids, metric, value, check_version) rows."""
    wide = measured.select(*id_columns, *(F.col(m).cast("double").alias(m) for m in metrics))
    return wide.unpivot(list(id_columns), list(metrics), "metric", "value").withColumn(
        "check_version", F.lit(check_version)
    )
