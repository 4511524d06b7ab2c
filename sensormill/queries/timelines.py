"""Nearest frames, capture rates and pose continuity over event time lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.operators.nearest import (
    nearest_frames,
    nearest_to_one_sweep,
    skew_distribution,
    skew_report,
)
from sensormill.operators.sweeps import (
    capture_intervals,
    capture_rate,
    laser_returns,
    pose_continuity,
    pose_steps,
    returns_against_history,
    returns_spread,
    sweep_stats,
    sweep_timing,
)
from sensormill.queries.registry import EVENT_FRAMES_SQL, event_frames, query, table

HOUR_NS = 3_600_000_000_000
DAY_NS = 24 * HOUR_NS
# A click is a sweep; the other event types are cameras, one of which never delivers.
CAMERAS = ("error", "purchase", "signup", "stereo_front_left", "view")
_CAMERAS_SQL = ", ".join(f"('{c}')" for c in CAMERAS)


def _sweeps(frames: DataFrame) -> DataFrame:
    return frames.where("sensor = 'click'")


def _all_skews(spark: SparkSession, folder: str, bin_ns: int | None = None) -> DataFrame:
    frames = event_frames(spark, folder)
    return nearest_frames(_sweeps(frames), frames.where("sensor <> 'click'"), CAMERAS, bin_ns)


_TARGETS = f"""{EVENT_FRAMES_SQL}, cameras(sensor) AS (VALUES {_CAMERAS_SQL}),
targets AS (SELECT DISTINCT f.log_id, c.sensor, f.timestamp_ns AS sweep_ns
            FROM frames f CROSS JOIN cameras c WHERE f.sensor = 'click')"""
_SKEWS = f"""{_TARGETS},
best AS (SELECT t.log_id, t.sensor, t.sweep_ns,
    arg_min(f.timestamp_ns, (abs(f.timestamp_ns - t.sweep_ns), f.timestamp_ns)) AS frame_ns
  FROM targets t JOIN frames f ON f.log_id = t.log_id AND f.sensor = t.sensor GROUP BY ALL),
skews AS (SELECT t.log_id, t.sensor, t.sweep_ns, b.frame_ns, b.frame_ns - t.sweep_ns AS skew_ns,
    CAST(b.frame_ns - t.sweep_ns AS DOUBLE) / 1e6 AS skew_ms
  FROM targets t LEFT JOIN best b ON b.log_id = t.log_id AND b.sensor = t.sensor AND b.sweep_ns = t.sweep_ns)"""


@query(f"WITH {_SKEWS} SELECT * FROM skews")
def nearest_skew(spark: SparkSession, folder: str) -> DataFrame:
    """With bins of five days, as for sensors of a known rate."""
    return _all_skews(spark, folder, 5 * DAY_NS)


def _rank_sql(rows: str, by: str, value: str, percents: tuple[int, ...]) -> str:
    """Nearest-rank percentiles as SQL over a sorted window."""
    picks = ", ".join(
        f"max(CASE WHEN rn = greatest(1, (cnt * {p} + 99) // 100) THEN {value} END) AS p{p}" for p in percents
    )
    return f"""SELECT {by}, count(*) AS n, {picks} FROM (
  SELECT {by}, {value}, row_number() OVER (PARTITION BY {by} ORDER BY {value}) AS rn,
         count(*) OVER (PARTITION BY {by}) AS cnt FROM {rows} WHERE {value} IS NOT NULL) GROUP BY {by}"""


@query(
    f"""WITH {_SKEWS}, ranks AS ({_rank_sql("skews", "sensor", "skew_ns", (5, 50, 95))}),
spread AS (SELECT sensor, count(*) AS n_sweeps,
    CAST(sum(CASE WHEN skew_ns IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_without_frame,
    min(skew_ns) AS min_ns, max(skew_ns) AS max_ns FROM skews GROUP BY sensor)
SELECT s.*, r.p5, r.p50, r.p95 FROM spread s LEFT JOIN ranks r ON r.sensor = s.sensor"""
)
def skew_distribution_per_camera(spark: SparkSession, folder: str) -> DataFrame:
    return skew_distribution(_all_skews(spark, folder), by=["sensor"])


_FIRST = f"""{EVENT_FRAMES_SQL}, cameras(sensor) AS (VALUES {_CAMERAS_SQL}),
targets AS (SELECT f.log_id, c.sensor, f.sweep_ns FROM (
  SELECT log_id, min(timestamp_ns) AS sweep_ns FROM frames WHERE sensor = 'click' GROUP BY log_id) f
  CROSS JOIN cameras c)"""
_FIRST_SKEWS = _FIRST + _SKEWS[len(_TARGETS) :]


def _first_skews(spark: SparkSession, folder: str) -> DataFrame:
    frames = event_frames(spark, folder)
    first = _sweeps(frames).groupBy("log_id").agg(F.min("timestamp_ns").alias("timestamp_ns"))
    return nearest_to_one_sweep(first, frames.where("sensor <> 'click'"), CAMERAS)


@query(f"WITH {_FIRST_SKEWS} SELECT * FROM skews")
def nearest_to_first_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return _first_skews(spark, folder)


@query(f"WITH {_FIRST_SKEWS} SELECT log_id, sensor, format('{{:+.2f}} ms', skew_ms) AS skew FROM skews")
def skew_report_lines(spark: SparkSession, folder: str) -> DataFrame:
    return skew_report(_first_skews(spark, folder))


_INTERVALS = f"""{EVENT_FRAMES_SQL}, i AS (
  SELECT *, timestamp_ns - lag(timestamp_ns) OVER (PARTITION BY log_id, sensor ORDER BY timestamp_ns, event_id)
    AS interval_ns FROM frames)"""


@query(
    f"""WITH {_INTERVALS},
ranks AS ({_rank_sql("i", "log_id, sensor", "interval_ns", (50, 95))}),
c AS (SELECT log_id, sensor, count(interval_ns) AS n_intervals,
    CAST(sum(CASE WHEN abs(interval_ns - {DAY_NS}) > 0.5 * {DAY_NS} THEN 1 ELSE 0 END) AS BIGINT) AS n_off_rate,
    max(interval_ns) AS max_interval_ns FROM i GROUP BY ALL)
SELECT c.*, r.p50, r.p95 FROM c LEFT JOIN ranks r ON r.log_id = c.log_id AND r.sensor = c.sensor"""
)
def capture_rate_per_sensor(spark: SparkSession, folder: str) -> DataFrame:
    frames = event_frames(spark, folder)
    intervals = capture_intervals(frames, ties=["event_id"])
    return capture_rate(intervals, F.lit(DAY_NS))


def _poses(spark: SparkSession, folder: str) -> DataFrame:
    """Events as poses: value and k are the place, the angle turns with k."""
    half = F.col("k") / F.lit(100.0)
    return event_frames(spark, folder).select(
        "log_id",
        "timestamp_ns",
        "event_id",
        F.cos(half).alias("qw"),
        F.lit(0.0).alias("qx"),
        F.lit(0.0).alias("qy"),
        F.sin(half).alias("qz"),
        F.col("value").alias("tx_m"),
        F.col("k").cast("double").alias("ty_m"),
        F.lit(0.0).alias("tz_m"),
    )


_POSES = f"""{EVENT_FRAMES_SQL}, p AS (
  SELECT log_id, event_id, timestamp_ns, value AS x, CAST(k AS DOUBLE) AS y, cos(k / 100.0) AS qw, sin(k / 100.0) AS qz
  FROM frames),
q AS (SELECT *, lag(timestamp_ns) OVER w AS t0, lag(x) OVER w AS x0, lag(y) OVER w AS y0, lag(qw) OVER w AS w0,
  lag(qz) OVER w AS z0 FROM p WINDOW w AS (PARTITION BY log_id ORDER BY timestamp_ns, event_id)),
steps AS (SELECT log_id, event_id, timestamp_ns - t0 AS step_ns, sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0))
  AS distance_m, 2 * acos(least(1.0, abs(qw * w0 + qz * z0))) AS angle_rad FROM q)"""


@query(
    f"""WITH {_POSES} SELECT log_id, event_id, step_ns, round(distance_m, 6) AS distance_m,
round(angle_rad, 5) AS angle_rad FROM steps"""
)
def pose_step_measures(spark: SparkSession, folder: str) -> DataFrame:
    """With bins of ten days, as for poses of a known rate."""
    steps = pose_steps(_poses(spark, folder), bin_ns=10 * DAY_NS, payload_ties=["event_id"])
    return steps.select(
        "log_id",
        "event_id",
        "step_ns",
        F.round("distance_m", 6).alias("distance_m"),
        F.round("angle_rad", 5).alias("angle_rad"),
    )


def _continuity(spark: SparkSession, folder: str) -> DataFrame:
    return _first_check(_steps(spark, folder))


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    return pose_steps(_poses(spark, folder), payload_ties=["event_id"])


def _first_check(steps: DataFrame) -> DataFrame:
    return pose_continuity(steps, max_step_ns=12 * HOUR_NS, max_distance_m=50.5, max_angle_rad=0.505)


_CONTINUITY = f"""{_POSES}, c AS (SELECT log_id, count(*) AS n_poses, max(step_ns) AS max_step_ns,
  CAST(sum(CASE WHEN step_ns > {12 * HOUR_NS} THEN 1 ELSE 0 END) AS BIGINT) AS n_gaps,
  CAST(sum(CASE WHEN distance_m > 50.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_jumps,
  CAST(sum(CASE WHEN angle_rad > 0.505 THEN 1 ELSE 0 END) AS BIGINT) AS n_turns FROM steps GROUP BY log_id)"""


@query(f"WITH {_CONTINUITY} SELECT * FROM c")
def pose_continuity_per_log(spark: SparkSession, folder: str) -> DataFrame:
    return _continuity(spark, folder)


@query(
    f"""WITH {_CONTINUITY}, m AS (
  SELECT log_id, 'n_poses' AS metric, CAST(n_poses AS DOUBLE) AS value FROM c
  UNION ALL SELECT log_id, 'max_step_ns', CAST(max_step_ns AS DOUBLE) FROM c
  UNION ALL SELECT log_id, 'n_gaps', CAST(n_gaps AS DOUBLE) FROM c
  UNION ALL SELECT log_id, 'n_jumps', CAST(n_jumps AS DOUBLE) FROM c)
SELECT log_id, metric, value, 'pose-1' AS check_version FROM m"""
)
def sweep_stat_rows(spark: SparkSession, folder: str) -> DataFrame:
    metrics = ["n_poses", "max_step_ns", "n_gaps", "n_jumps"]
    return sweep_stats(_continuity(spark, folder), metrics, "pose-1", id_columns=["log_id"])


@query(
    f"""WITH {EVENT_FRAMES_SQL}, r AS (
  SELECT log_id, sensor, timestamp_ns // {DAY_NS} AS day, count(*) AS n_returns FROM frames GROUP BY ALL),
h AS (SELECT *, count(n_returns) OVER w AS history_n, CAST(sum(n_returns) OVER w AS BIGINT) AS history_sum FROM r
  WINDOW w AS (PARTITION BY log_id, sensor ORDER BY day ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
SELECT log_id, sensor, day, n_returns, history_n, history_sum,
  coalesce(2 * n_returns * history_n < history_sum, FALSE) AS collapsed FROM h"""
)
def returns_per_laser(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per sensor and day against the five preceding days with data."""
    frames = event_frames(spark, folder).withColumn("day", F.floor(F.col("timestamp_ns") / DAY_NS))
    keys = ["log_id", "sensor"]
    returns = laser_returns(frames, keys, "day")
    return returns_against_history(returns, 5, keys, "day").drop("history_mean")


@query(
    f"""WITH {EVENT_FRAMES_SQL}, r AS (
  SELECT log_id, sensor, timestamp_ns // {DAY_NS} AS day, count(*) AS n_returns FROM frames GROUP BY ALL),
h AS (SELECT *, count(n_returns) OVER w AS history_n, CAST(sum(n_returns) OVER w AS DOUBLE) AS s, CAST(sum(n_returns * n_returns) OVER w AS DOUBLE) AS q FROM r
  WINDOW w AS (PARTITION BY log_id, sensor ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
d AS (SELECT *, s / nullif(history_n, 0) AS history_mean, sqrt(greatest(0.0, q * history_n - s * s)) / nullif(history_n, 0) AS history_std FROM h)
SELECT log_id, sensor, day, n_returns, history_n, round(history_mean, 6) AS history_mean, round(history_std, 6) AS history_std,
  coalesce(abs(n_returns - history_mean) > 2.0 * history_std, FALSE) AS deviating FROM d"""
)
def returns_spread_per_laser(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per sensor and day against mean and deviation of the seven preceding days with data."""
    frames = event_frames(spark, folder).withColumn("day", F.floor(F.col("timestamp_ns") / DAY_NS))
    found = returns_spread(laser_returns(frames, ["log_id", "sensor"], "day"), 7, ["log_id", "sensor"], "day", limit=2.0)
    return found.withColumns({c: F.round(c, 6) for c in ("history_mean", "history_std")})


@query(
    """WITH s AS (SELECT *, length(text) AS off,
  lag(length(text)) OVER (PARTITION BY conv_id, role ORDER BY turn) AS prev FROM conversations)
SELECT conv_id, count(*) AS n_points, CAST(max(off) - min(off) AS BIGINT) AS span_ns,
  CAST(sum(CASE WHEN off < prev THEN 1 ELSE 0 END) AS BIGINT) AS n_steps_back,
  abs(max(off) - min(off) - 1000) <= 500 AS spans_revolution FROM s GROUP BY conv_id"""
)
def timing_within_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """A conversation is a sweep, its roles the lasers and the text length the offset."""
    turns = table(spark, folder, "conversations").withColumn("off", F.length("text").cast("bigint"))
    return sweep_timing(turns, ["conv_id"], "role", "turn", "off", revolution_ns=1000, tolerance_ns=500)
