import pytest
from logtree import make_log
from pyspark.sql import functions as F

from sensormill.operators import releases, tree
from sensormill.plans.backfill import backfill
from sensormill.plans.ingest import ingest
from sensormill.plans.release import ReleaseRefused, Releases
from sensormill.plans.store import CatalogStore, ParquetStore


def folders_of(spark, root, *ids):
    return spark.createDataFrame([(i, f"{root}/{i}") for i in ids], "log_id string, root string")


def test_a_release_loads_the_same_rows_or_names_what_changed(spark, tmp_path):
    folder = make_log(tmp_path, "L1", cameras=("ring_front_center",), frames=2)
    store = ParquetStore(spark, str(tmp_path / "store"))
    ingest(store, folders_of(spark, tmp_path, "L1"), "v1")
    pins = Releases(store, str(tmp_path / "releases"))
    with pytest.raises(ReleaseRefused, match="never published"):
        pins.load("r1")
    logs = folders_of(spark, tmp_path, "L1")
    pins.create("r1", logs, "strict-1", "v1")
    with pytest.raises(ValueError, match="exists"):
        pins.create("r1", logs, "strict-1", "v1")
    first = {t: df.count() for t, df in pins.load("r1").items()}
    assert first["sensor_data"] == 4 and first["pose"] == 6
    # A later commit of the same log does not change the release.
    extra = folder / "sensors/lidar/900.feather"
    extra.write_bytes(b"new sweep")
    ingest(store, logs, "v1")
    assert {t: df.count() for t, df in pins.load("r1").items()} == first
    pins.create("r2", logs, "strict-1", "v1")
    assert {r.table_name for r in pins.compare("r1", "r2").collect()} == {"sensor_data", "log"}
    assert pins.compare("r1", "r1").count() == 0
    # Blobs behind the rows change or vanish.
    frame = folder / "sensors/cameras/ring_front_center/103.jpg"
    original = frame.read_bytes()
    frame.write_bytes(original[::-1])
    (folder / "sensors/lidar/100.feather").rename(folder / "sensors/lidar/100.held")
    with pytest.raises(ReleaseRefused) as refusal:
        pins.load("r1")
    assert f"blob {frame}: checksum_differs" in str(refusal.value)
    assert "lidar/100.feather: missing" in str(refusal.value)
    assert {t: df.count() for t, df in pins.load("r1", check_blobs=False).items()} == first
    # Rows lost from the store are seen without looking at blobs.
    broken = ParquetStore(spark, str(tmp_path / "store"))
    broken.read = lambda table, as_of=None: ParquetStore.read(broken, table).where(
        F.lit(table != "pose") | (F.col("qw" if table == "pose" else "log_id") != "3.0")
    )
    with pytest.raises(ReleaseRefused, match="table pose: rows_differ"):
        Releases(broken, str(tmp_path / "releases")).load("r1", check_blobs=False)


def test_a_release_without_its_header_does_not_exist(spark, tmp_path):
    make_log(tmp_path, "L1", cameras=("ring_front_center",), frames=1)
    store = ParquetStore(spark, str(tmp_path / "store"))
    ingest(store, folders_of(spark, tmp_path, "L1"), "v1")
    pins = Releases(store, str(tmp_path / "releases"))
    whole = Releases._write
    for dies_after in ("commits", "tables", "blobs"):

        def dies(self, part, rows, key, value, last=dies_after):
            whole(self, part, rows, key, value)
            if part == last:
                raise RuntimeError("the job dies here")

        pins._write = dies.__get__(pins)
        with pytest.raises(RuntimeError):
            pins.create("half", folders_of(spark, tmp_path, "L1"), "strict-1", "v1")
        assert not pins.exists("half")
        with pytest.raises(ReleaseRefused):
            pins.load("half")
    # The state goes on, and the release is made at last: nothing of the dead attempts is in it.
    (tmp_path / "L1/sensors/lidar/900.feather").write_bytes(b"new sweep")
    ingest(store, folders_of(spark, tmp_path, "L1"), "v1")
    pins._write = whole.__get__(pins)
    pins.create("half", folders_of(spark, tmp_path, "L1"), "strict-1", "v1")
    assert pins.part("commits", "half").count() == 1 and pins.part("tables", "half").count() == 5
    assert pins.load("half")["sensor_data"].where("timestamp_ns = 900").count() == 1


def test_states_order_by_version_not_by_arrival(spark):
    events = spark.createDataFrame([("r", 3, "approved"), ("r", 1, "draft"), ("s", 2, "gated")], "release_id string, version int, state string")
    newest = releases.newest_states(events)
    assert {r.release_id: r.state for r in newest.collect()} == {"r": "approved", "s": "gated"}
    late = spark.createDataFrame([("r", 2, "gated"), ("r", 3, "again"), ("t", 1, "draft"), ("s", 3, "x")], events.schema)
    assert {(r.release_id, r.version) for r in releases.stale_events(late, newest).collect()} == {("r", 2), ("r", 3)}


def test_consistent_slices(spark):
    rows = spark.createDataFrame(
        [("L", 1, "lidar", "a"), ("L", 1, "cam", "a"), ("L", 2, "lidar", "a"), ("L", 3, "cam", "a"), ("L", 3, "cam", "b"), ("L", 3, "lidar", None)],
        "log_id string, sample int, sensor string, calibration_id string",
    )
    both = releases.consistent_samples(rows, ["log_id", "sample"], ["lidar", "cam"])
    assert {r.sample for r in both.collect()} == {1, 3}
    loose = releases.consistent_samples(rows, ["log_id", "sample"], ["lidar", "cam"], allow_missing=1)
    assert {r.sample for r in loose.collect()} == {1, 2, 3}
    assert {r.sample for r in releases.consistent_calibration(rows, ["log_id", "sample"]).collect()} == {1, 2}


def test_backfill_does_each_unit_once_and_survives_a_rerun(spark, tmp_path):
    units = spark.createDataFrame([("L1", "lidar"), ("L1", "cam"), ("L2", "lidar")], "log_id string, sensor string")
    out, done = str(tmp_path / "out"), str(tmp_path / "done")

    def run(slice_, value):
        return {tuple(r) for r in backfill(units, slice_, ["log_id", "sensor"], lambda w: w.withColumn("v", F.lit(value)), out, done).collect()}

    assert run(F.col("sensor") == "lidar", 1) == {("L1", "lidar"), ("L2", "lidar")}
    assert run(F.lit(True), 2) == {("L1", "cam")}
    assert run(F.lit(True), 3) == set()
    assert {(r.log_id, r.sensor, r.v) for r in spark.read.parquet(out).collect()} == {("L1", "lidar", 1), ("L2", "lidar", 1), ("L1", "cam", 2)}


def test_snapshots_tags_and_time_travel(spark, tmp_path):
    from pyspark.sql import types as T

    store = ParquetStore(spark, str(tmp_path / "probe"), {"t": T.StructType.fromDDL("k bigint, v string")})
    store.ensure_tables()
    store.ensure_tables()
    assert store.snapshot_ids() == {"t": None}
    store.append("t", spark.createDataFrame([(1, "a")], "k int, v string"), 10)
    store.tag("release/probe", "t", store.snapshot_ids()["t"])
    assert store.append("t", spark.createDataFrame([(2, None)], "k bigint, v string"), 20) == 1
    assert [r.k for r in store.read("t", as_of=store.tagged("release/probe", "t")).collect()] == [1]
    assert sorted(r.k for r in store.read("t").collect()) == [1, 2]
    assert store.tagged("absent", "t") is None


def test_catalog_store_with_a_builtin_provider(spark, tmp_path):
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS probe_ns LOCATION '{tmp_path}/ns'")
    store = CatalogStore(spark, "probe_ns", provider="parquet")
    try:
        store.ensure_tables()
        store.ensure_tables()
        rows = spark.createDataFrame([("L", "lidar", 5)], "log_id string, sensor string, timestamp_ns int")
        assert store.append("sensor_data", rows) == 1
        row = store.read("sensor_data").first()
        assert (row.log_id, row.sensor, row.timestamp_ns, row.checksum) == ("L", "lidar", 5, None)
        assert store.snapshot_ids(["log"]) == {"log": None}
        assert store.ledger().count() == 0
    finally:
        spark.sql("DROP NAMESPACE probe_ns CASCADE")


def test_a_tree_names_the_rows_and_looks_only_where_it_differs(spark):
    rows = [(i, i % 7, f"v{i}") for i in range(3000)] + [(5, 5, "v5"), (None, 1, "no key")]
    ddl = "k bigint, g int, v string"
    then = spark.createDataFrame(rows, ddl)
    now = [r for r in rows if r[0] not in (10, 5)] + [(5, 5, "v5"), (20, 20 % 7, "v20"), (4000, 0, "new")]
    now = [(k, g, "other" if k == 30 else v) for k, g, v in now]
    depth = tree.depth_for(len(rows), rows_per_leaf=8)
    assert depth == 3

    def made(content):
        marked = tree.marks(spark.createDataFrame(content, ddl).repartition(4), ["k"], depth)
        return marked, tree.nodes(marked, depth)

    (one, first), (same, again), (two, second) = made(rows), made(rows[::-1]), made(now)
    leaves, looked = tree.unequal_leaves(first, again, depth)
    assert leaves.count() == 0 and looked == [(1, 0)]  # equal: the root is enough
    leaves, looked = tree.unequal_leaves(first, second, depth)
    found = {(r.key, r.problem, r.n_pinned, r.n_now) for r in tree.differing_keys(one, two, leaves).collect()}
    assert found == {
        ('{"k":10}', "lost", 1, 0), ('{"k":5}', "changed", 2, 1), ('{"k":20}', "doubled", 1, 2), ('{"k":30}', "changed", 1, 1), ('{"k":4000}', "added", 0, 1)
    }
    assert looked[0] == (1, 1) and looked[3][1] == leaves.count() <= 5
    assert sum(n for n, _ in looked) <= 1 + 16 + 2 * 5 * 16 < first.count() / 3
    # No rows at all, on either side.
    none, empty = made([])
    for left, right in ((first, empty), (empty, first)):
        assert tree.unequal_leaves(left, right, depth)[0].count() > 300
    assert tree.unequal_leaves(empty, empty, depth)[0].count() == 0


def test_a_refusal_names_rows(spark, tmp_path):
    make_log(tmp_path, "L1", cameras=("ring_front_center",), frames=2)
    store = ParquetStore(spark, str(tmp_path / "store"))
    logs = folders_of(spark, tmp_path, "L1")
    ingest(store, logs, "v1")
    Releases(store, str(tmp_path / "releases")).create("r1", logs, "strict-1", "v1")
    broken = ParquetStore(spark, str(tmp_path / "store"))
    stamps = sorted(r.timestamp_ns for r in store.read("pose").collect())

    def read(table, as_of=None):
        rows = ParquetStore.read(broken, table)
        if table != "pose":
            return rows
        changed = F.when(F.col("timestamp_ns") == stamps[1], F.col("tx_m") + 1).otherwise(F.col("tx_m"))
        kept = rows.where(F.col("timestamp_ns") != stamps[0]).withColumn("tx_m", changed)
        return kept.unionByName(rows.where(F.col("timestamp_ns") == stamps[2]))

    broken.read = read
    pins = Releases(broken, str(tmp_path / "releases"))
    found, _ = pins.changed_rows("r1", "pose")
    name = '{{"log_id":"L1","timestamp_ns":{}}}'.format
    expected = {(name(stamps[0]), "lost"), (name(stamps[1]), "changed"), (name(stamps[2]), "doubled")}
    assert {(r.key, r.problem) for r in found.collect()} == expected
    with pytest.raises(ReleaseRefused, match="4 objects differ") as refusal:
        pins.load("r1", check_blobs=False)
    assert "table pose: rows_differ; row pose " in str(refusal.value)
    assert pins.changed_rows("r1", "track")[0].count() == 0
