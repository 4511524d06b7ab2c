"""Where the vehicle was at any moment: poses interpolated at a point's own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormill.operators.ordered import with_neighbours

ROTATION = ("qw", "qx", "qy", "qz")
PLACE = ("tx_m", "ty_m", "tz_m")
#: Rotations closer than this (as the product of their quaternions) are interpolated along the straight line.
ALMOST_EQUAL = 0.9995


def pose_at(points: DataFrame, poses: DataFrame, keys: Sequence[str] = ("log_id",), time: str = "timestamp_ns", bin_ns: float | None = None) -> DataFrame:
    """Points with the pose of their own time: qw, qx, qy, qz, tx_m, ty_m, tz_m.

    The pose lies between the last one at or before the point and the first one at or after it: the place on the straight
    line, the rotation on the shortest arc, both in proportion to time. A sweep's points are recorded while the vehicle
    moves, so one pose per sweep would bend the ground. Outside the recorded poses nothing is guessed: the pose is NULL.
    """
    found = with_neighbours(points, poses, keys, time, [*ROTATION, *PLACE], bin_ns)
    t, t0, t1 = F.col(time), F.col(f"before.{time}"), F.col(f"after.{time}")
    part = F.when(t1 > t0, (t - t0).cast("double") / (t1 - t0).cast("double")).when(t1 == t0, F.lit(0.0))
    moved = found.withColumn("_part", part)
    place = {c: _straight(F.col(f"before.{c}"), F.col(f"after.{c}")) for c in PLACE}
    return moved.withColumns({**_arc(), **place}).drop("before", "after", "_part")


def _straight(a: Column, b: Column) -> Column:
    return a + (b - a) * F.col("_part")


def _arc() -> dict[str, Column]:
    """Spherical interpolation. A rotation has two quaternions; the nearer one of the second pose is taken."""
    dot = sum((F.col(f"before.{q}") * F.col(f"after.{q}") for q in ROTATION), F.lit(0.0))
    near = F.least(F.lit(1.0), F.abs(dot))
    angle, part = F.acos(near), F.col("_part")
    straight = near > ALMOST_EQUAL
    first = F.when(straight, 1 - part).otherwise(F.sin((1 - part) * angle) / F.sin(angle))
    second = F.when(straight, part).otherwise(F.sin(part * angle) / F.sin(angle)) * F.when(dot < 0, -1.0).otherwise(1.0)
    mixed = {q: first * F.col(f"before.{q}") + second * F.col(f"after.{q}") for q in ROTATION}
    length = F.sqrt(sum((c * c for c in mixed.values()), F.lit(0.0)))
    return {q: c / F.nullif(length, F.lit(0.0)) for q, c in mixed.items()}
