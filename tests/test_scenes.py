"""Episodes and poses at any moment, beside brute force."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensormill.operators.episodes import episodes, overlapping
from sensormill.operators.motion import pose_at
from sensormill.operators.ordered import with_neighbours, with_running_sum
from sensormill.operators.sweeps import in_world
from sensormill.queries import scenes
from sensormill.workspace import materialise

BIG = (1 << 62) + 5


def _islands(rows, gap):
    groups = defaultdict(list)
    for key, t in rows:
        if t is not None:
            groups[key].append(t)
    out = []
    for key, times in groups.items():
        times.sort()
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] > gap:
                out.append((key, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        out.append((key, run[0], run[-1], len(run)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_episodes_are_gaps_and_islands(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "a", None]), rng.randrange(2000)) for _ in range(700)]
    rows += [("a", None), ("lone", 5), ("far", -BIG), ("far", BIG), ("twice", 3), ("twice", 3)]
    df = spark.createDataFrame(rows, "k string, t bigint").repartition(5)
    found = [(r.k, r.start_ns, r.end_ns, r.n_rows) for r in episodes(df, ["k"], "t", 3).collect()]
    assert sorted(found, key=str) == _islands(rows, 3)
    assert episodes(df.limit(0), ["k"], "t", 3).count() == 0


@pytest.mark.parametrize("crowd", [2, 1000])
def test_overlaps_equal_all_pairs(spark, crowd):
    rng = random.Random(crowd)

    def some(n, name):
        out = []
        for i in range(n):
            start = rng.randrange(-500, 500)
            length = rng.choice([0, 0, 1, 7, 8, 9, 64, 900])
            out.append((rng.choice(["g", "g", None]), start, start + length, f"{name}{i}"))
        return out

    left = [*some(60, "l"), ("g", -BIG, BIG, "for ever"), ("g", None, 5, "no start"), ("g", 8, 8, "twin"), ("g", 8, 8, "twin")]
    right = [*some(70, "r"), ("h", 0, 5, "alone"), ("g", BIG, BIG, "end")]
    ddl = "k string, start_ns bigint, end_ns bigint, name string"
    pairs = overlapping(spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl), ["k"], finest=8, crowd=crowd)
    got = sorted(str((r.k, r.left_name, r.right_name, r.start_ns, r.end_ns, r.duration_ns)) for r in pairs.collect())
    expected = sorted(
        str((a[0], a[3], b[3], max(a[1], b[1]), min(a[2], b[2]), min(a[2], b[2]) - max(a[1], b[1])))
        for a in left
        for b in right
        if a[0] == b[0] and a[1] is not None and a[1] <= b[2] and b[1] <= a[2]
    )
    assert got == expected
    empty = spark.createDataFrame([], ddl)
    assert overlapping(empty, spark.createDataFrame(right, ddl), ["k"]).count() == 0


def test_a_crowded_stretch_is_many_pieces(spark):
    left = spark.range(600).select(F.lit("g").alias("k"), F.col("id").alias("start_ns"), F.lit(1000).cast("long").alias("end_ns"), "id")
    twins = left.limit(50).withColumns({"start_ns": F.lit(3).cast("long"), "id": F.lit(0).cast("long")})
    pairs = overlapping(left, twins, ["k"], finest=2000, crowd=100)
    shares = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect())
    assert sum(shares) == 600 * 50 and shares[-1] < 600 * 50 * 0.7


def test_running_sums_over_a_crowded_group(spark):
    rows = [("k", i, i % 7 - 3) for i in range(400)] + [(None, 1, 5)]
    found = with_running_sum(spark.createDataFrame(rows, "k string, t bigint, v bigint").repartition(6), ["k"], ["t"], "v", width=10)
    expected, total = {(None, 1): 5}, 0
    for k, t, v in rows[:-1]:
        total += v
        expected[(k, t)] = total
    assert {(r.k, r.t): r.running for r in found.collect()} == expected


@pytest.mark.parametrize("width", [None, 10])
def test_neighbours_equal_a_search(spark, width):
    rng = random.Random(5)
    points = [(rng.choice(["a", "a", None]), rng.randrange(300), i) for i in range(200)] + [("a", None, 900), ("empty", 4, 901)]
    marks = [(rng.choice(["a", "a", None]), rng.randrange(300), rng.randrange(9)) for _ in range(60)] + [("a", None, 1)]
    p, m = spark.createDataFrame(points, "k string, t bigint, i int"), spark.createDataFrame(marks, "k string, t bigint, v int")
    found = with_neighbours(p.repartition(4), m, ["k"], "t", ["v"], width).collect()
    got = {r.i: (r.before and tuple(r.before), r.after and tuple(r.after)) for r in found}
    expected = {}
    for k, t, i in points:
        own = [] if t is None else [(mt, v) for mk, mt, v in marks if mk == k and mt is not None]
        expected[i] = (max((x for x in own if x[0] <= t), default=None), min((x for x in own if x[0] >= t), default=None))
    assert len(found) == len(points) and got == expected


def test_poses_lie_on_the_arc_between_their_neighbours(spark):
    pose = "log_id string, timestamp_ns bigint, qw double, qx double, qy double, qz double, tx_m double, ty_m double, tz_m double"

    def turned(degrees, sign=1.0):
        half = math.radians(degrees) / 2
        return sign * math.cos(half), 0.0, 0.0, sign * math.sin(half)

    poses = spark.createDataFrame(
        [("a", 0, *turned(0), 0.0, 0.0, 0.0), ("a", 100, *turned(90, -1.0), 10.0, 0.0, 4.0), ("a", 110, *turned(90.5), 10.0, 0.0, 4.0)], pose
    )
    points = [("a", 50, "half"), ("a", 0, "first"), ("a", 100, "mark"), ("a", 105, "close"), ("a", 111, "after"), ("b", 5, "none"), ("a", None, "when")]
    placed = pose_at(spark.createDataFrame(points, "log_id string, timestamp_ns bigint, name string"), poses)
    rows = {r.name: r for r in placed.collect()}
    angles = {n: None if r.qw is None else round(math.degrees(2 * math.atan2(r.qz, r.qw)) % 360, 4) for n, r in rows.items()}
    assert angles == {"half": 45.0, "first": 0.0, "mark": 90.0, "close": 90.25, "after": None, "none": None, "when": None}
    assert (rows["half"].tx_m, rows["half"].tz_m, rows["after"].tx_m) == (5.0, 2.0, None)
    world = in_world(placed.withColumns({"x": F.lit(1.0), "y": F.lit(0.0), "z": F.lit(0.0)})).where("name = 'half'").first()
    assert (round(world.wx, 6), round(world.wy, 6), round(world.wz, 6)) == (round(5 + math.sqrt(0.5), 6), round(math.sqrt(0.5), 6), 2.0)


def test_only_what_turns_are_found_by_is_written(spark, tmp_path, monkeypatch):
    rows = [(i, f"2024-01-0{1 + i % 7} 00:00:00", i % 3, "view", float(i), f'{{"k": {i % 50}}}') for i in range(60)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    written = []
    monkeypatch.setattr("sensormill.operators.ordered.materialise", lambda df, label: written.append(df.columns) or materialise(df, label))
    assert scenes._turns(spark, str(tmp_path)).count() > 0
    assert "timestamp_ns" in written[0] and not {"event_id", "category", "tx_m", "ty_m"} & {c for columns in written for c in columns}
