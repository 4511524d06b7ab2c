import os
import re
import uuid

import pandas as pd
import pyarrow as pa
import pytest
from logtree import make_log

from sensormill.operators import ledger as ledgers
from sensormill.operators.integrity import dangling_calibrations, lidar_references
from sensormill.operators.multiset import compare, differences, same_rows
from sensormill.operators.normalise import canonical_tables, unreadable_stamps
from sensormill.plans.ingest import ingest, plan_commits
from sensormill.plans.reconcile import active_rows, reconcile, reconcile_keys
from sensormill.plans.store import ParquetStore, next_snapshot_id
from sensormill.queries import ingested
from sensormill.sources.files import hash_files, list_files, log_folders, log_list
from sensormill.sources.keys import source_keys


def folders_of(spark, root, *ids):
    return spark.createDataFrame([(i, f"{root}/{i}") for i in ids], "log_id string, root string")


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "store"))


def actions(result):
    return {r.log_id: r.action for r in result.logs.collect()}


def test_three_logs_reconcile_and_a_rerun_adds_nothing(spark, tmp_path, store):
    for i in ("L1", "L2", "L3"):
        make_log(tmp_path, i)
    folders = folders_of(spark, tmp_path, "L1", "L2", "L3")
    first = ingest(store, folders, "v1")
    assert actions(first) == {"L1": "committed", "L2": "committed", "L3": "committed"}
    assert first.rows_written == {"sensor_data": 27, "pose": 18, "calibration": 9, "track": 9, "log": 3}
    report = reconcile(store, folders).collect()
    assert {r.log_id for r in report} == {"L1", "L2", "L3"}
    assert all(r.passed and r.completeness == 1.0 and r.status == "ok" for r in report)
    line = next(r for r in report if r.log_id == "L1")
    assert line.line == f"L1 commit={line.commit_id} completeness=100.000000% missing=0 extra=0 duplicate=0"
    before = {t: store.read(t).count() for t in store.schemas}
    again = ingest(store, folders, "v1")
    assert set(actions(again).values()) == {"unchanged"} and set(again.rows_written.values()) == {0}
    assert {t: store.read(t).count() for t in store.schemas} == before
    assert store.ledger().count() == 3
    assert set(actions(ingest(store, folders, "v2")).values()) == {"committed"}  # a new transform is a new identity


def test_restoring_an_earlier_source_reactivates_its_commit(spark, tmp_path, store):
    folder = make_log(tmp_path, "L1")
    folders = folders_of(spark, tmp_path, "L1")
    a = ingest(store, folders, "v1").logs.first().commit_id
    frame = folder / "sensors/cameras/ring_side_left/103.jpg"
    frame.rename(frame.with_suffix(".held"))
    # Still a stamped file for the source side, so the key is missing from the table.
    b = ingest(store, folders, "v1").logs.first()
    assert b.action == "committed" and b.commit_id != a
    bad = reconcile(store, folders).first()
    assert not bad.passed and bad.missing == 1 and bad.status == "incomplete" and " missing=1 " in bad.line
    assert [(r.sensor, r.timestamp_ns) for r in differences(reconcile_keys(store, folders)).collect()] == [
        ("ring_side_left", 103)
    ]
    frame.with_suffix(".held").rename(frame)
    rows = store.read("sensor_data").count()
    back = ingest(store, folders, "v1").logs.first()
    assert back.action == "reactivated" and back.commit_id == a
    assert store.read("sensor_data").count() == rows
    assert reconcile(store, folders).first().passed


def test_a_job_that_stops_between_tables_leaves_nothing_visible(spark, tmp_path, store):
    make_log(tmp_path, "L1")
    folders = folders_of(spark, tmp_path, "L1")
    store.ensure_tables()
    hashed = hash_files(list_files(folders))
    planned = plan_commits(folders, hashed, store.ledger(), "v1", uuid.uuid4().hex)
    for name, rows in canonical_tables(planned, hashed).items():
        store.append(name, rows, next_snapshot_id())
        if name == "pose":
            break  # the job dies here
    assert store.ledger().count() == 0
    assert store.read("sensor_data").count() == 9 and store.read("pose").count() == 6
    assert store.read("track").count() == 0 and store.snapshot_ids()["track"] is None
    assert active_rows(store, "sensor_data").count() == 0
    committed = ledgers.commits(store.ledger())
    left_over = ledgers.commit_ids(ledgers.uncommitted(store.read("sensor_data"), committed)).collect()
    assert len(left_over) == 1
    done = ingest(store, folders, "v1").logs.first()
    assert done.action == "committed" and done.commit_id != left_over[0].ingest_commit_id
    assert reconcile(store, folders).first().passed
    assert active_rows(store, "sensor_data").count() == 9
    assert ledgers.uncommitted(store.read("sensor_data"), ledgers.commits(store.ledger())).count() == 9


def test_calibrations_resolve_last_row_wins_and_lidar_has_none(spark, tmp_path, store):
    make_log(tmp_path, "L1")
    folders = folders_of(spark, tmp_path, "L1")
    ingest(store, folders, "v1")
    sensor, calibration = active_rows(store, "sensor_data"), active_rows(store, "calibration")
    assert dangling_calibrations(sensor, calibration).count() == 0
    lidar = lidar_references(sensor).first()
    assert lidar.n_rows == 3 and lidar.n_calibrated == 0
    rows = {r.sensor: r for r in calibration.collect()}
    assert set(rows) == {"ring_front_center", "ring_side_left", "up_lidar"}
    assert rows["ring_front_center"].qw == 3.0  # the repeated name: its last row
    assert rows["up_lidar"].fx_px is None and rows["ring_side_left"].fx_px == 2.0
    assert rows["ring_side_left"].calibration_id == "L1/ring_side_left"
    gone = calibration.where("sensor != 'ring_side_left'")
    assert dangling_calibrations(sensor, gone).count() == 3


def test_rows_match_the_source_and_carry_size_and_checksum(spark, tmp_path, store):
    import hashlib

    folder = make_log(tmp_path, "L1")
    folders = folders_of(spark, tmp_path, "L1")
    ingest(store, folders, "v1")
    row = active_rows(store, "sensor_data").where("sensor = 'lidar' AND timestamp_ns = 100").first()
    data = (folder / "sensors/lidar/100.feather").read_bytes()
    assert (row.byte_size, row.checksum) == (len(data), hashlib.sha256(data).hexdigest())
    assert row.source_path == str(folder / "sensors/lidar/100.feather") and row.codec == "feather"
    log = active_rows(store, "log").first()
    assert (log.start_ns, log.end_ns, log.city, log.source_digest) == (100, 303, None, None)
    assert log.source_path == str(folder)
    keys = ["log_id", "sensor", "timestamp_ns"]
    assert differences(compare(source_keys(folders), active_rows(store, "sensor_data"), keys)).count() == 0
    assert same_rows(source_keys(folders), active_rows(store, "sensor_data"), keys).first().same


def test_source_digest_sees_moves_edits_and_hidden_files(spark, tmp_path):
    from sensormill.plans.ingest import source_digests

    def digest(root):
        folders = folders_of(spark, root, "L")
        return source_digests(folders, hash_files(list_files(folders))).first().source_digest

    def tree(root, **files):
        for name, text in files.items():
            path = root / "L" / name.replace("__", "/")
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
        return digest(root)

    one = tree(tmp_path / "a", sensors__lidar__100="aaaa", annotations="bbbb")
    assert one == tree(tmp_path / "elsewhere" / "b", sensors__lidar__100="aaaa", annotations="bbbb")
    assert one != tree(tmp_path / "c", sensors__lidar__100="aaaa", annotations="cccc")
    assert one != tree(tmp_path / "d", sensors__lidar__200="aaaa", annotations="bbbb")
    (tmp_path / "a" / "L" / "sensors" / "_hidden").write_text("x")
    assert digest(tmp_path / "a") != one
    import hashlib

    items = sorted(
        f"{n}|{hashlib.sha256(t).hexdigest()}".encode() for n, t in (("sensors/lidar/100", b"aaaa"), ("annotations", b"bbbb"))
    )
    assert one == hashlib.sha256(b"".join(b"%d:%b" % (len(i), i) for i in items)).hexdigest()


def test_bad_logs_are_refused_and_the_others_go_on(spark, tmp_path, store):
    make_log(tmp_path, "good")
    (make_log(tmp_path, "broken") / "annotations.feather").unlink()
    folders = folders_of(spark, tmp_path, "good", "broken", "../etc")
    assert actions(ingest(store, folders, "v1")) == {"good": "committed", "broken": "refused", "../etc": "refused"}
    report = {r.log_id: r for r in reconcile(store, folders_of(spark, tmp_path, "good", "broken")).collect()}
    assert report["good"].passed and report["broken"].line == "broken not ingested"


def test_empty_log_is_not_complete(spark, tmp_path, store):
    import shutil

    shutil.rmtree(make_log(tmp_path, "L1") / "sensors")
    folders = folders_of(spark, tmp_path, "L1")
    assert ingest(store, folders, "v1").rows_written["sensor_data"] == 0
    assert store.snapshot_ids()["sensor_data"] is None
    log = active_rows(store, "log").first()
    assert (log.start_ns, log.end_ns) == (0, 0)
    report = reconcile(store, folders).first()
    assert report.status == "empty_source" and not report.passed and report.completeness is None


def test_overlong_stamps_go_to_quarantine(spark, tmp_path):
    folder = make_log(tmp_path, "L1")
    (folder / "sensors/lidar/99999999999999999999.feather").write_text("x")
    hashed = hash_files(list_files(folders_of(spark, tmp_path, "L1")))
    assert [r.stamp for r in unreadable_stamps(hashed).collect()] == ["99999999999999999999"]
    store = ParquetStore(spark, str(tmp_path / "store"))
    done = ingest(store, folders_of(spark, tmp_path, "L1"), "v1")
    row = store.quarantine().first()
    assert done.quarantined == 1 and (row.log_id, row.reason, row.detail) == ("L1", "stamp_too_long", "99999999999999999999")
    assert row.commit_id == done.logs.first().commit_id
    assert ingest(store, folders_of(spark, tmp_path, "L1"), "v1").quarantined == 0  # nothing new was taken in


def test_odd_names_and_roots(spark, tmp_path, store):
    folder = make_log(tmp_path, "L1")
    for name, text in (("notes %41 #1.txt", "a"), ("%41.txt", "b"), ("A.txt", "c"), (".hidden é ?", "d")):
        (folder / name).write_text(text)
    import hashlib

    for root in (f"{tmp_path}/L1", f"file://{tmp_path}/L1"):
        hashed = hash_files(list_files(spark.createDataFrame([("L1", root)], "log_id string, root string"))).collect()
        sums = {r.path.rsplit("/", 1)[1]: r.checksum for r in hashed}
        for name, text in (("notes %41 #1.txt", "a"), ("%41.txt", "b"), ("A.txt", "c"), (".hidden é ?", "d")):
            assert sums[name] == hashlib.sha256(text.encode()).hexdigest(), (root, name)
    make_log(tmp_path / "other", "L2")
    make_log(tmp_path, "L2")
    rows = [("L1", f"{tmp_path}/L1/"), ("L1", f"{tmp_path}/L1"), ("L2", f"{tmp_path}/L2"), ("L2", f"{tmp_path}/other/L2")]
    done = ingest(store, spark.createDataFrame(rows, "log_id string, root string"), "v1")
    assert actions(done) == {"L1": "committed", "L2": "refused"} and done.logs.count() == 2
    assert [(r.log_id, r.reason) for r in store.quarantine().collect()] == [("L2", "several_roots")]


def test_reading_one_log_opens_only_its_append(spark, tmp_path, store):
    for i in ("L1", "L2"):
        make_log(tmp_path, i)
        ingest(store, folders_of(spark, tmp_path, i), "v1")
    rows = active_rows(store, "sensor_data", folders_of(spark, tmp_path, "L2"))
    assert {r.log_id for r in rows.select("log_id").distinct().collect()} == {"L2"} and rows.count() == 9
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*append_id#\d+L? (=|IN) ", plan), plan


def test_racing_writers_of_one_identity_keep_the_earlier_commit(spark):
    ledger = spark.createDataFrame(
        [(1, "L", "c1", "d", "v"), (2, "L", "c2", "d", "v"), (3, "L", "c3", "e", "v"), (4, "L", "c2", "d", "v")],
        "seq bigint, log_id string, commit_id string, source_digest string, transform_version string",
    )
    assert {r.commit_id for r in ledgers.commits(ledger).collect()} == {"c1", "c3"}
    acts = ledgers.activations(ledger)
    assert ledgers.latest(acts).first().commit_id == "c1"
    assert ledgers.latest(acts, as_of=3).first().commit_id == "c3"


def test_log_list_skips_blank_lines(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("a\n\n b \na\n")
    listed = log_folders(log_list(spark, str(tmp_path / "ids.txt")), "/data/")
    assert sorted(tuple(r) for r in listed.collect()) == [("a", "/data/a"), ("b", "/data/b")]


def test_table_files_of_a_log_are_written_batch_by_batch(tmp_path):
    hot, small, sizes = f"{tmp_path}/hot", f"{tmp_path}/small", []

    def batches():
        for i in range(6):
            ids = range(2000 * i, 2000 * (i + 1))
            yield pd.DataFrame({"root": hot, "doc_id": ids, "lang": "de", "n_chars": 3})
            sizes.append(os.path.getsize(f"{hot}/annotations.feather"))
        yield pd.DataFrame({"root": [hot, small], "doc_id": [12000, 7], "lang": ["en", None], "n_chars": [3, 4]})

    assert sum(part["n"][0] for part in ingested._table_files(batches())) == 12002
    assert sizes == sorted(set(sizes)) and sizes[0] > 0  # every batch is in the file before the next one is asked for
    for name in ("city_SE3_egovehicle", "annotations"):
        assert pa.ipc.open_file(f"{hot}/{name}.feather").read_all()["timestamp_ns"].to_pylist() == list(range(12001))
        assert pa.ipc.open_file(f"{small}/{name}.feather").read_all()["timestamp_ns"].to_pylist() == [7]
