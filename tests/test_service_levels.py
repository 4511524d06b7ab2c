"""Sketches that merge, slices of all conditions, deviations from history, and dead letters of a stream."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators import releases
from sensormill.operators.slis import merged, sketch, sketch_quantiles
from sensormill.operators.sweeps import returns_spread
from sensormill.plans.sli_store import SliStore
from sensormill.plans.store import ParquetStore
from sensormill.streaming import replay, sinks
from sensormill.streaming.envelopes import EnvelopeSink


def test_percentiles_of_sketches_are_close_however_they_are_merged(spark):
    rng = random.Random(1)
    values = [rng.choice([1, -1]) * int(10 ** rng.uniform(0, 15)) for _ in range(3000)] + [0] * 50 + [None]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "part int, v bigint").repartition(5)
    parts = sketch(df, ["part"], "v")
    whole = sketch_quantiles(parts.select("bucket", "n"), [], (1, 25, 50, 75, 99)).first()
    exact = sorted(v for v in values if v is not None)
    assert whole.n == len(exact)
    for percent in (1, 25, 50, 75, 99):
        at = exact[max(1, (len(exact) * percent + 99) // 100) - 1]
        assert abs(whole[f"p{percent}"] - at) <= 0.0101 * abs(at)
    once, twice = (sorted(map(tuple, m.collect())) for m in (merged(parts, []), merged(merged(parts, ["part"]), [])))
    assert once == twice
    doubles = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (1e-300,), (1e300,)], "v double")
    assert [round(x, 2) if x < 2 else x for x in sketch_quantiles(sketch(doubles, [], "v"), [], (25, 50)).select("p25", "p50").first()] == [0.0, 0.0]
    assert sketch(df.limit(0), ["part"], "v").count() == 0


def test_stored_levels_of_releases(spark, tmp_path):
    store = SliStore(spark, str(tmp_path / "slis"), ["log_id"], 100)
    ddl = "log_id string, emitted bigint, landed bigint, bad boolean"
    first = spark.createDataFrame([("a", 0, 10, True), ("a", 0, 150, None), ("b", 5, 25, False)], ddl)
    second = spark.createDataFrame([("a", 100, 110, True), ("c", 0, 7, True)], ddl)
    signals = {"bad": F.col("bad"), "late": F.col("landed") - F.col("emitted") > 100}
    for batch, rows in ((0, first), (1, second), (0, first)):  # the first batch runs again
        store.add(rows, batch, "emitted", "landed", signals)
    members = spark.createDataFrame([("r", "a"), ("r", "a"), ("s", "a"), ("s", "b"), ("t", "none")], "release_id string, log_id string")
    found = {r.release_id: r for r in store.of_releases(members, ["bad", "late"]).collect()}
    assert (found["r"].n, found["r"].bad, found["r"].late) == (3, 2, 1) and abs(found["r"].p50 - 10) <= 0.1
    assert (found["s"].n, found["s"].bad, found["s"].late) == (4, 2, 1) and abs(found["s"].p50 - 10) <= 0.1
    assert (found["t"].n, found["t"].p50, found["t"].bad) == (0, None, 0)
    assert {(r.window_ns, r.n) for r in store.series().collect()} == {(0, 3), (100, 2)}


def test_samples_must_meet_all_conditions(spark):
    rows = [
        (1, "lidar", None, "l1"), (1, "cam", "v1", "c1"), (1, "cam2", "v1", "d1"),  # whole
        (2, "lidar", None, "l2"), (2, "cam", "v0", "c1"), (2, "cam2", "v1", "d1"),  # an old calibration
        (3, "lidar", None, "gone"), (3, "cam", "v1", "c1"), (3, "cam2", "v1", "d1"),  # no payload for lidar
        (4, "cam", "v1", "c1"), (4, "cam2", "v1", "d1"),  # no lidar
        (5, "lidar", None, "l2"), (5, "cam", "v1", "c1"), (5, "cam", "v0", "c1"), (5, "other", "v9", "x"),  # two versions
        (6, "other", "v9", "x"), (7, "lidar", None, None), (7, "cam", None, "c1"), (None, "lidar", None, "l1"),
    ]
    df = spark.createDataFrame(rows, "sample int, sensor string, calibration_id string, source_path string").repartition(3)
    wanted = spark.createDataFrame([("cam", "v1"), ("cam2", "v1"), ("other", "v1")], "sensor string, calibration_id string")
    blobs = spark.createDataFrame([(p,) for p in ("l1", "l2", "c1", "d1", "d1")], "source_path string")

    def usable(allow, always=("lidar",)):
        found = releases.usable_samples(df, ["sample"], ["lidar", "cam", "cam2"], always, wanted, blobs, allow)
        return {r["sample"]: (r.present, r.miscalibrated, r.without_blob, r.n_usable) for r in found.where("usable").collect()}

    assert usable(0) == {1: (7, 0, 0, 3)}
    assert usable(1) == {1: (7, 0, 0, 3), 2: (7, 2, 0, 2)}
    assert set(usable(2)) == {1, 2, 5, None}
    assert set(usable(1, ())) == {1, 2, 3, 4}
    with pytest.raises(ValueError, match="63"):
        usable(0, ("radar",))


@pytest.mark.parametrize("history", [1, 4, 50])
def test_deviation_from_history(spark, history):
    rng = random.Random(history)
    rows = [("L", 1, t, rng.choice([5, 5, 6, 90])) for t in range(0, 120, 2)] + [("L", 2, t, 7) for t in range(9)] + [("L", None, 1, 3), ("M", 1, 4, 1 << 40)]
    df = spark.createDataFrame(rows, "log_id string, laser_number int, sweep_ns bigint, n_returns bigint").repartition(4)
    found = returns_spread(df, history).collect()
    assert len(found) == len(rows)
    for r in found:
        past = [n for log, laser, t, n in rows if (log, laser) == (r.log_id, r.laser_number) and t < r.sweep_ns][-history:]
        assert r.history_n == len(past)
        if past:
            assert math.isclose(r.history_mean, statistics.fmean(past)) and math.isclose(r.history_std, statistics.pstdev(past), abs_tol=1e-9)
            assert r.deviating == (abs(r.n_returns - r.history_mean) > 3 * r.history_std)
        else:
            assert (r.history_mean, r.history_std, r.deviating) == (None, None, False)


def test_rows_and_dead_letters_become_visible_together(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "store"), {})
    store.ensure_tables()
    failed_file = spark.createDataFrame([("L", "a.jpg", "file_missing")], "log_id string, object string, reason string")
    store.append_quarantine(failed_file, 5)
    events = [(1, "t", '{"n": 1}'), (2, "t", '{"n": "x"}'), (3, "u", '{"n": 3'), (4, None, None), (2, "t", '{"n": "x"}')]
    df = spark.createDataFrame(events, "event_id bigint, topic string, value string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    sink, other = (EnvelopeSink(store, str(tmp_path / name), name, "n BIGINT") for name in ("one", "two"))
    schema = T.StructType.fromDDL("event_id BIGINT, topic STRING, n BIGINT")
    mark, runs = sink.mark, []

    def dies_once(marker, batch_id):
        runs.append(batch_id)
        if len(runs) == 1:
            raise RuntimeError("killed")
        mark(marker, batch_id)

    sink.mark = dies_once
    stream = replay.replay(spark, str(tmp_path / "in"), df.schema)
    with pytest.raises(Exception, match="killed"):
        sinks.run_available(stream, lambda rows, batch: sink(rows, batch), str(tmp_path / "cp"))
    assert sink.rows(schema).count() == 0 and sink.dead().count() == 0  # both are written, neither is visible
    assert store.quarantine_appends().where("append_id < 0").count() == 4
    sinks.run_available(stream, lambda rows, batch: sink(rows, batch), str(tmp_path / "cp"))
    assert runs == [0, 0]
    assert [(r.event_id, r.n) for r in sink.rows(schema).collect()] == [(1, 1)]
    dead = sorted((r.object, r.reason, str(r.detail)) for r in sink.dead().collect())
    assert dead == sorted([("2", "envelope_malformed", '{"n": "x"}')] * 2 + [("3", "envelope_malformed", '{"n": 3'), ("4", "envelope_malformed", "None")])
    assert store.quarantine().count() == 5 and store.quarantine().where("reason = 'file_missing'").count() == 1
    assert other.rows(schema).count() == 0 and other.append_id(0) != sink.append_id(0)
