"""Binned operators against brute force, with bins and blocks small enough to matter."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sensormill.operators import ordered
from sensormill.operators.nearest import nearest_frames, nearest_to_one_sweep, skew_distribution, skew_report


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(ordered, "BINS_PER_BLOCK", 4)


def brute_nearest(stamps, sweep):
    return min(sorted(stamps), key=lambda t: abs(t - sweep)) if stamps else None


@pytest.mark.parametrize("width", [1, 7, 100, None])
def test_nearest_equals_brute_force(spark, width):
    rng = random.Random(5)
    frames = [(log, cam, rng.randrange(-50, 400)) for log in "AB" for cam in "xy" for _ in range(25)]
    frames += [("A", "x", 1000), ("A", "x", 1000), ("C", "x", 5)]
    sweeps = [(log, rng.randrange(-80, 500)) for log in "ABC" for _ in range(30)] + [("A", 2000), ("C", 7), ("C", 7)]
    found = nearest_frames(
        spark.createDataFrame(sweeps, "log_id string, timestamp_ns bigint"),
        spark.createDataFrame(frames, "log_id string, sensor string, timestamp_ns bigint"),
        ["x", "y", "empty"],
        width,
    ).collect()
    expected = {
        (log, cam, s): brute_nearest([t for a, b, t in frames if (a, b) == (log, cam)], s)
        for log, s in sweeps
        for cam in ("x", "y", "empty")
    }
    assert {(r.log_id, r.sensor, r.sweep_ns): r.frame_ns for r in found} == expected
    assert len(found) == len(expected)
    assert all(r.skew_ns == (None if r.frame_ns is None else r.frame_ns - r.sweep_ns) for r in found)


def test_ties_go_to_the_earlier_frame_and_reports_are_signed(spark):
    frames = spark.createDataFrame(
        [("A", "x", 90), ("A", "x", 110), ("A", "y", 1_005_100)], "log_id string, sensor string, timestamp_ns bigint"
    )
    sweep = spark.createDataFrame([("A", 100)], "log_id string, timestamp_ns bigint")
    for found in (nearest_frames(sweep, frames, ["x", "y"], 3), nearest_to_one_sweep(sweep, frames, ["x", "y"])):
        rows = {r.sensor: r for r in found.collect()}
        assert rows["x"].frame_ns == 90 and rows["x"].skew_ms == -1e-05
        lines = {r.sensor: r.skew for r in skew_report(found).collect()}
        # 1.005 is slightly below its decimal text, so it rounds down
        assert lines == {"x": "-0.00 ms", "y": "+1.00 ms"}


def test_cameras_may_come_from_the_data(spark):
    frames = spark.createDataFrame([("A", "x", 1), ("B", "y", 2)], "log_id string, sensor string, timestamp_ns bigint")
    sweeps = spark.createDataFrame([("A", 0), ("B", 0)], "log_id string, timestamp_ns bigint")
    found = nearest_frames(sweeps, frames, frames.select("log_id", "sensor").distinct())
    assert {(r.log_id, r.sensor, r.frame_ns) for r in found.collect()} == {("A", "x", 1), ("B", "y", 2)}


@pytest.mark.parametrize("width", [1, 10, None])
def test_previous_equals_lag_also_for_null_keys(spark, width):
    rng = random.Random(7)
    rows = [(k, rng.randrange(-60, 60), i) for i in range(80) for k in ("a", None)]
    df = spark.createDataFrame(rows, "k string, t bigint, i int")
    found = ordered.with_previous(df, ["k"], "t", width, ties=["i"], payload=["k"])
    expected = {}
    for k in ("a", None):
        mine = sorted((t, i) for kk, t, i in rows if kk == k)
        expected.update({(k, i): (mine[n - 1] if n else None) for n, (t, i) in enumerate(mine)})
    got = {(r.k, r.i): (None if r.previous is None else (r.previous.t, r.previous.i)) for r in found.collect()}
    assert got == expected and found.columns == ["k", "t", "i", "previous"]


def test_position_counts_through_bins(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), (F.col("id") * 7).alias("t"))
    found = ordered.with_position(df, ["k"], "t", 20)
    for k in range(3):
        rows = sorted((r.t, r.position) for r in found.where(F.col("k") == k).collect())
        assert [p for _, p in rows] == list(range(len(rows)))


@pytest.mark.parametrize("width", [0.5, 9.0, None])
def test_percentiles_are_exact_ranks(spark, width):
    rng = random.Random(3)
    rows = [("a", float(rng.randrange(-30, 30))) for _ in range(101)] + [("b", 4.0), ("c", None), ("a", None), ("d", math.nan), ("d", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: r for r in ordered.distribution(df, ["k"], "v", (1, 50, 99, 100), width).collect()}
    mine = sorted(v for k, v in rows if k == "a" and v is not None)
    for p in (1, 50, 99, 100):
        assert found["a"][f"p{p}"] == mine[max(1, math.ceil(len(mine) * p / 100)) - 1]
    assert (found["a"].n, found["a"].n_null, found["a"].min, found["a"].max) == (101, 1, mine[0], mine[-1])
    assert found["b"].p1 == found["b"].p100 == 4.0
    assert (found["c"].n, found["c"].n_null, found["c"].p50) == (0, 1, None)
    assert found["d"].p50 == 1.0 and math.isnan(found["d"].p100)


def test_skew_distribution_keeps_empty_cameras(spark):
    skews = spark.createDataFrame([("A", "x", v) for v in (5, -5, 3)] + [("A", "y", None)], "log_id string, sensor string, skew_ns bigint")
    rows = {r.sensor: r for r in skew_distribution(skews).collect()}
    assert (rows["x"].n_sweeps, rows["x"].min_ns, rows["x"].p50, rows["x"].max_ns) == (3, -5, 3, 5)
    assert (rows["y"].n_sweeps, rows["y"].n_without_frame, rows["y"].p50) == (1, 1, None)


EXTREMES = (-math.inf, -1e300, -1.0, 0.0, 0.0, 2.0, 1e15, math.inf, math.nan)


@pytest.mark.parametrize("width", [None, 1.0])
def test_outliers_infinities_and_nan(spark, width):
    rows = [(k, v) for k in ("a", None) for v in EXTREMES] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for row in ordered.distribution(df, ["k"], "v", (1, 50, 88), width).collect():
        assert (row.n, row.p1, row.p50, row.p88) == (9, -math.inf, 0.0, math.inf) and math.isnan(row.max)
    stamps = [-(1 << 63), -(1 << 62), 0, 1, (1 << 62) + 5, (1 << 63) - 1]
    times = spark.createDataFrame([("x", t) for t in stamps], "k string, t bigint")
    got = {r.t: r.previous for r in ordered.with_previous(times, ["k"], "t", width).collect()}
    assert [got[t] and got[t].t for t in stamps] == [None, *stamps[:-1]]


def test_nearest_over_the_whole_range_of_stamps(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    frames = spark.createDataFrame([("A", "x", low), ("A", "x", high)], "log_id string, sensor string, timestamp_ns bigint")
    sweeps = spark.createDataFrame([("A", low), ("A", -5), ("A", 5), ("A", high)], "log_id string, timestamp_ns bigint")
    found = {r.sweep_ns: r.frame_ns for r in nearest_frames(sweeps, frames, ["x"]).collect()}
    assert found == {low: low, -5: low, 5: high, high: high}


def test_bins_of_a_crowded_group_hold_like_numbers_of_rows(spark):
    crowd = spark.range(20_000).select(F.lit("a").alias("k"), (F.col("id") % 50).alias("t"), "id")
    outlier = spark.createDataFrame([("a", 10**15, -1)], "k string, t bigint, id bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ordered.binned(crowd.unionByName(outlier), ["k"], ["t", "id"])
        sizes = [r["count"] for r in cut.groupBy(ordered.BIN).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * 20_001 / 8
