"""All six sensor checks in one stored table, one of them in two versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators.nearest import skew_distribution
from sensormill.operators.ordered import quantiles
from sensormill.operators.sweeps import laser_returns, pose_continuity, returns_spread
from sensormill.plans import sweep_stat
from sensormill.plans.store import ParquetStore
from sensormill.queries import scenes, timelines
from sensormill.queries.registry import EVENT_FRAMES_SQL, ORACLES, event_frames, query
from sensormill.queries.timelines import DAY_NS, HOUR_NS
from sensormill.workspace import fresh_path, materialise

_METRICS = {
    "returns-1": ("n_returns", "history_std", "deviating"),
    "range-1": ("n_points", "p50", "p95"),
    "timing-1": ("n_steps_back", "span_ns"),
    "skew-1": ("n_sweeps", "n_without_frame", "p50"),
    "ground-1": ("n_on_raster", "mean_m", "rms_m"),
}
_POSE = {"pose-1": ("n_poses", "n_gaps", "n_jumps", "max_step_ns"), "pose-2": ("n_gaps", "n_turns")}
#: Logs that the second version of the pose check has looked at.
_AGAIN = "log_id >= '5'"


def _unpivot(rows: str, version: str, metrics: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT log_id, sensor, sweep_ns, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, '{version}' AS check_version FROM {rows}" for m in metrics
    )


_SQL = f"""WITH {EVENT_FRAMES_SQL},
f AS (SELECT log_id, sensor, timestamp_ns // {DAY_NS} * {DAY_NS} AS sweep_ns, value FROM frames),
returns AS (SELECT *, {DAY_NS} * day AS sweep_ns FROM ({ORACLES["returns_spread_per_laser"]})),
ranges AS (SELECT * RENAME (n AS n_points) FROM ({timelines._rank_sql("f", "log_id, sensor, sweep_ns", "value", (50, 95))})),
timing AS (SELECT *, 'conversation-' || conv_id AS log_id, 'lidar' AS sensor, NULL::BIGINT AS sweep_ns FROM ({ORACLES["timing_within_sweep"]})),
skewed AS (SELECT * FROM ({ORACLES["nearest_skew"]})),
skew AS (SELECT s.*, r.p50, NULL::BIGINT AS sweep_ns FROM (SELECT log_id, sensor, count(*) AS n_sweeps, count(*) FILTER (skew_ns IS NULL) AS n_without_frame
  FROM skewed GROUP BY ALL) s LEFT JOIN ({timelines._rank_sql("skewed", "log_id, sensor", "skew_ns", (50,))}) r USING (log_id, sensor)),
ground AS (SELECT *, 'lidar' AS sensor, NULL::BIGINT AS sweep_ns FROM ({ORACLES["ground_residual_at_own_time"]})),
pose AS (SELECT *, NULL::VARCHAR AS sensor, NULL::BIGINT AS sweep_ns FROM ({ORACLES["pose_continuity_per_log"]})),
pose2 AS (WITH {timelines._POSES} SELECT log_id, NULL::VARCHAR AS sensor, NULL::BIGINT AS sweep_ns, count(*) FILTER (step_ns > {6 * HOUR_NS}) AS n_gaps,
  count(*) FILTER (angle_rad > 0.305) AS n_turns FROM steps GROUP BY log_id)
{_unpivot("returns", "returns-1", _METRICS["returns-1"])} UNION ALL {_unpivot("ranges", "range-1", _METRICS["range-1"])}
UNION ALL {_unpivot("timing", "timing-1", _METRICS["timing-1"])} UNION ALL {_unpivot("skew", "skew-1", _METRICS["skew-1"])}
UNION ALL {_unpivot("ground", "ground-1", _METRICS["ground-1"])}
UNION ALL {_unpivot(f"(SELECT * FROM pose WHERE NOT {_AGAIN})", "pose-1", _POSE["pose-1"])}
UNION ALL {_unpivot(f"(SELECT * FROM pose2 WHERE {_AGAIN})", "pose-2", _POSE["pose-2"])}"""


@query(_SQL)
def sweep_stat_table(spark: SparkSession, folder: str) -> DataFrame:
    """Returns, ranges, timing, skew, pose and ground as rows of one table. A second version of the pose check has seen
    some of the logs since, and a first one was recorded twice."""
    frames = event_frames(spark, folder).withColumn("day", F.floor(F.col("timestamp_ns") / DAY_NS))
    daily = (F.col("day") * DAY_NS).alias("sweep_ns")
    keys = ["log_id", "sensor"]
    returns = returns_spread(laser_returns(frames, keys, "day"), 7, keys, "day", limit=2.0)
    ranges = quantiles(frames.select(*keys, daily, "value"), [*keys, "sweep_ns"], "value", (50, 95)).withColumnRenamed("n", "n_points")
    timing = timelines.timing_within_sweep(spark, folder)
    skew = skew_distribution(timelines._all_skews(spark, folder), percents=(50,))
    ground = scenes.ground_residual_at_own_time(spark, folder)
    measured = {
        "returns-1": returns.select(*keys, daily, "n_returns", F.round("history_std", 6).alias("history_std"), F.col("deviating").cast("int").alias("deviating")),
        "range-1": ranges,
        "timing-1": timing.select(F.concat(F.lit("conversation-"), "conv_id").alias("log_id"), F.lit("lidar").alias("sensor"), "n_steps_back", "span_ns"),
        "skew-1": skew,
        "ground-1": ground.withColumn("sensor", F.lit("lidar")),
    }
    store = ParquetStore(spark, fresh_path(spark, "stats"), {sweep_stat.TABLE: T.StructType.fromDDL(sweep_stat.DDL)})
    store.ensure_tables()
    # The steps serve both versions, and the first one is recorded twice.
    steps = materialise(timelines._steps(spark, folder).select("log_id", "step_ns", "distance_m", "angle_rad"), "pose-steps")
    first = {"pose-1": (materialise(timelines._first_check(steps), "pose-check"), _POSE["pose-1"])}
    sweep_stat.record(store, {version: (df, _METRICS[version]) for version, df in measured.items()} | first, 10)
    second = pose_continuity(steps.where(_AGAIN), max_step_ns=6 * HOUR_NS, max_distance_m=50.5, max_angle_rad=0.305)
    sweep_stat.record(store, {"pose-2": (second, _POSE["pose-2"])}, 20)
    sweep_stat.record(store, first, 30)  # late news of the old version change nothing where there is a newer one
    return sweep_stat.current(store)
