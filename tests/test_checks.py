"""Every gate and check is shown to fail on data that breaks it."""

import math

import pytest
from pyspark.sql import functions as F

from sensormill.operators import gates, integrity, sweeps
from sensormill.operators.blobs import byte_accounts, file_health, manifest, orphans, verify


def test_gates_count_skips_and_going_silent_is_an_alert(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id int, q int")
    rules = {"quality": F.col("q") == 1, "never_looked": F.lit(None).cast("boolean"), "ids": F.col("id") > 0}
    counters = gates.gate_counters(gates.evaluate_gates(df, rules, ["id"]))
    found = {r.gate: (r.evaluated, r.passed, r.failed, r.skipped) for r in counters.collect()}
    assert found == {"quality": (2, 1, 1, 1), "never_looked": (0, 0, 0, 3), "ids": (3, 3, 0, 0)}
    assert {r.gate for r in gates.silent_gates(counters).collect()} == {"quality", "never_looked"}


def test_mart_totals_agree_with_its_parts(spark):
    rows = [("g", "a", True), ("g", "a", None), ("g", "b", False), ("h", None, True)]
    df = spark.createDataFrame(rows, "gate string, source string, passed boolean")
    found = {(r.gate, r.source, r.level): (r.evaluated, r.passed, r.failed, r.skipped) for r in gates.gate_mart(df, ["gate", "source"]).collect()}
    assert found[(None, None, 3)] == (3, 2, 1, 1)
    assert found[("g", None, 1)] == (2, 1, 1, 1)
    assert found[("h", None, 0)] == found[("h", None, 1)] == (1, 1, 0, 0)


def test_quarantine_splits_without_loss_and_null_conditions_do_not_count(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    good, bad = gates.split_quarantine(df, {"negative": F.col("v") < 0, "odd_id": F.col("id") % 2 == 1})
    assert sorted(r.id for r in good.collect()) == [2]
    assert {r.id: r.reasons for r in bad.collect()} == {1: ["odd_id"], 3: ["negative", "odd_id"]}
    assert {r.reason: r.n_rows for r in gates.quarantine_depth(bad).collect()} == {"odd_id": 2, "negative": 1}


def test_recall_is_per_fault_type(spark):
    faults = spark.createDataFrame([(1, "gap"), (2, "gap"), (3, "skew")], "id int, fault_type string")
    found = gates.fault_recall(faults, spark.createDataFrame([(1,), (1,), (9,)], "id int"), ["id"])
    assert {r.fault_type: r.recall for r in found.collect()} == {"gap": 0.5, "skew": 0.0}


def test_blob_outcomes_orphans_and_manifest(spark):
    ddl = "source_path string, byte_size bigint, checksum string"
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "y"), ("d", 1, "z")], ddl)
    now = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 1, "w"), ("e", 1, "v")], ddl)
    assert {r.source_path: r.outcome for r in verify(rows, now).collect()} == {
        "a": "ok", "b": "size_differs", "c": "checksum_differs", "d": "missing",
    }
    assert [r.source_path for r in orphans(now, rows).collect()] == ["e"]
    assert {r.blob_key: r.n_references for r in manifest(rows).collect()} == {"blobs/x/x": 2, "blobs/y/y": 1, "blobs/z/z": 1}
    accounts = byte_accounts(rows, "byte_size", {"all": F.lit(True), "none": F.lit(False)})
    assert {r.account: (r.n_rows, r.n_bytes) for r in accounts.collect()} == {"all": (4, 4), "none": (0, 0)}


def test_file_health_counts_small_files(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    row = file_health(spark.read.parquet(str(tmp_path / "t")), small_bytes=10_000_000).first()
    assert (row.n_files, row.n_small_files, row.n_rows) == (3, 3, 100)


def test_a_laser_that_collapses_is_seen_against_its_own_history(spark, monkeypatch):
    monkeypatch.setattr(sweeps, "ROWS_PER_BLOCK", 8)
    counts = [("L", laser, s, (100 if laser == 1 else 10) if s != 30 or laser == 2 else 20) for laser in (1, 2) for s in range(40)]
    df = spark.createDataFrame(counts, "log_id string, laser_number int, sweep_ns bigint, n_returns bigint")
    found = sweeps.returns_against_history(df, history=5).collect()
    assert len(found) == 80
    assert [(r.laser_number, r.sweep_ns) for r in found if r.collapsed] == [(1, 30)]
    for r in found:
        past = [n for _, la, s, n in counts if la == r.laser_number and r.sweep_ns - 5 <= s < r.sweep_ns]
        assert (r.history_n, r.history_sum) == (len(past), sum(past) if past else None)
    for r in sweeps.returns_against_history(df, history=20).collect():  # more sweeps than a block holds
        past = [n for _, la, s, n in counts if la == r.laser_number and r.sweep_ns - 20 <= s < r.sweep_ns]
        assert (r.history_n, r.history_sum) == (len(past), sum(past) if past else None)
    with pytest.raises(ValueError):
        sweeps.returns_against_history(df, history=0)


def test_sweep_timing_sees_steps_back_in_recorded_order(spark):
    rows = [("L", s, i, i % 2, off) for s, offs in ((1, [0, 0, 50, 60, 100, 100]), (2, [0, 0, 50, 60, 40, 70])) for i, off in enumerate(offs)]
    df = spark.createDataFrame(rows, "log_id string, sweep_ns bigint, row_index bigint, laser_number int, offset_ns bigint")
    found = {r.sweep_ns: r for r in sweeps.sweep_timing(df, revolution_ns=100, tolerance_ns=5).collect()}
    assert (found[1].n_steps_back, found[1].spans_revolution) == (0, True)
    assert (found[2].n_steps_back, found[2].span_ns, found[2].spans_revolution) == (1, 70, False)


def test_pose_gaps_jumps_and_turns(spark):
    half = math.sqrt(0.5)
    rows = [("L", 0, 1.0, 0.0, 0.0), ("L", 10, 1.0, 0.0, 1.0), ("L", 500, 1.0, 0.0, 9.0), ("L", 510, half, half, 9.0), ("M", 5, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "log_id string, timestamp_ns bigint, qw double, qz double, tx_m double")
    zero = F.lit(0.0)
    steps = sweeps.pose_steps(df.withColumns({"qx": zero, "qy": zero, "ty_m": zero, "tz_m": zero}))
    found = {r.log_id: r for r in sweeps.pose_continuity(steps, 100, 2.0, 0.2).collect()}
    assert (found["L"].n_gaps, found["L"].n_jumps, found["L"].n_turns, found["L"].max_step_ns) == (1, 1, 1, 490)
    assert (found["M"].n_poses, found["M"].n_gaps, found["M"].max_step_ns) == (1, 0, None)
    turn = max(r.angle_rad for r in steps.where("angle_rad IS NOT NULL").collect())
    assert turn == pytest.approx(math.pi / 2)


def test_ground_residual_of_a_tilted_sensor(spark):
    half = math.sqrt(0.5)
    points = spark.createDataFrame([("L", 1, 1.0, 0.0, 0.5), ("L", 1, 2.0, 0.0, 0.5)], "log_id string, sweep_ns bigint, x double, y double, z double")
    pose = spark.createDataFrame([("L", 1, half, 0.0, 0.0, half, 10.0, 20.0, 100.0)], "log_id string, timestamp_ns bigint, qw double, qx double, qy double, qz double, tx_m double, ty_m double, tz_m double")
    world = sweeps.to_world(points, pose)
    assert [(round(r.wx, 6), round(r.wy, 6), r.wz) for r in world.orderBy("x").collect()] == [(10.0, 21.0, 100.5), (10.0, 22.0, 100.5)]
    spot = world.orderBy("x").select(F.floor(F.col("wx") / 0.3), F.floor(F.col("wy") / 0.3)).collect()
    raster = spark.createDataFrame([("L", *map(int, spot[0]), 100.2)], "log_id string, cell_x bigint, cell_y bigint, height_m double")
    row = sweeps.ground_residuals(world, raster).first()
    assert (row.n_points, row.n_on_raster) == (2, 1)
    assert row.mean_m == pytest.approx(0.3) and row.rms_m == pytest.approx(0.3) and row.max_abs_m == pytest.approx(0.3)


def test_capture_rate_and_stat_rows(spark):
    df = spark.createDataFrame([("L", "lidar", t) for t in (0, 100, 200, 500, 600)], "log_id string, sensor string, timestamp_ns bigint")
    row = sweeps.capture_rate(sweeps.capture_intervals(df), F.lit(100)).first()
    assert (row.n_intervals, row.n_off_rate, row.max_interval_ns, row.p50, row.p95) == (4, 1, 300, 100, 300)
    stats = sweeps.sweep_stats(df.limit(1).withColumn("a", F.lit(1)).withColumn("b", F.lit(2)), ["a", "b"], "v1", ["log_id", "sensor"])
    assert {(r.metric, r.value, r.check_version) for r in stats.collect()} == {("a", 1.0, "v1"), ("b", 2.0, "v1")}


def test_missing_sensors_and_bounds_of_empty_logs(spark):
    logs = spark.createDataFrame([("L",), ("M",)], "log_id string")
    rows = spark.createDataFrame([("L", "lidar", 5), ("L", "lidar", 9)], "log_id string, sensor string, timestamp_ns bigint")
    gaps = integrity.missing_sensors(logs, rows, ["lidar", "ring_side_left"]).collect()
    assert {tuple(r) for r in gaps} == {("L", "ring_side_left"), ("M", "lidar"), ("M", "ring_side_left")}
    assert integrity.missing_sensors(logs, rows).where("log_id = 'L'").count() == 9
    assert {tuple(r) for r in integrity.log_bounds(logs, rows).collect()} == {("L", 5, 9), ("M", 0, 0)}
