"""JSON arrays in byte ranges beside the parser of the standard library, and scenes under the ledger."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sensormill.operators import ledger as ledgers
from sensormill.plans.reconcile import active_rows
from sensormill.plans.scenes import ingest_scenes, reconcile_scenes, scene_tables
from sensormill.plans.store import ParquetStore
from sensormill.sources import json_arrays
from sensormill.sources.json_arrays import Scan, array_files, elements_of, json_elements, read_array
from sensormill.sources.json_scenes import read_scenes
from sensormill.sources.keys import scene_keys
from sensormill.workspace import materialise, spread


def _value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 6)
    if kind < 3:
        return "".join(rng.choices(['"', "\\", "[", "]", "{", "}", ",", "é", "\n", "a", "中", "/"], k=rng.randrange(8)))
    if kind < 6:
        return rng.choice([None, True, -1.5e3, 7, "\\\\\\", '\\"'])
    if kind == 6:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}\\\"[": _value(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.mark.parametrize("seed", range(6))
def test_any_ranges_give_the_same_elements(tmp_path, monkeypatch, seed):
    rng = random.Random(seed)
    values = [_value(rng) for _ in range(60)]
    text = json.dumps(values, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5).encode()
    if seed == 1:
        text = b"\xef\xbb\xbf \n" + text + b" \n"
    path = tmp_path / "a.json"
    path.write_bytes(text)
    monkeypatch.setattr(json_arrays, "BLOCK", rng.choice([1, 5, 64, 10_000]))
    for split in (1, 2, 7, 50, 10_000):
        found = []
        for begin in range(0, len(text), split):
            scan = Scan(0)
            scan.block(text[:begin])  # the true state, from the beginning of the file
            found += [json.loads(e) for e in elements_of(str(path), begin, min(begin + split, len(text)), len(text), scan.state, scan.depth)]
        assert found == values


def test_ranges_read_little_more_than_themselves(tmp_path, monkeypatch):
    text = json.dumps([{"id": i, "text": "a, [b" * 20} for i in range(5000)]).encode()
    path, read, blocks, split = tmp_path / "a.json", [], json_arrays._blocks, 1 << 14
    path.write_bytes(text)

    def counted(*args):
        for at, data in blocks(*args):
            read.append(len(data))
            yield at, data

    monkeypatch.setattr(json_arrays, "_blocks", counted)
    found = 0
    for begin in range(0, len(text), split):
        scan = Scan(0)
        scan.block(text[:begin])
        found += sum(1 for _ in elements_of(str(path), begin, min(begin + split, len(text)), len(text), scan.state, scan.depth))
    assert found == 5000 and sum(read) < 1.5 * len(text)


def test_states_compose_from_any_beginning():
    rng = random.Random(9)
    text = json.dumps([_value(rng) for _ in range(40)]).encode()
    for _ in range(200):
        a, b = sorted((rng.randrange(len(text) + 1), rng.randrange(len(text) + 1)))
        whole = Scan(0)
        whole.block(text[:b])
        first = Scan(0)
        first.block(text[:a])
        second = Scan(first.state)
        second.block(text[a:b])
        assert (second.state, first.depth + second.depth) == (whole.state, whole.depth)


def test_a_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"id": i, "text": 'a "quoted\\" [line],\n' * (i % 5), "more": [i, {"x": None}]} for i in range(500)]
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=2))
    files = array_files(spark, str(tmp_path / "one.json"))
    cut = json_elements(files, split=1000).withColumn("task", F.spark_partition_id())
    assert cut.select("task").distinct().count() > 1 and cut.count() == 500
    found, dead = read_array(spark, str(tmp_path / "one.json"), "id BIGINT, text STRING, more ARRAY<STRING>", split=1000)
    assert {r.id: r.text for r in found.collect()} == {r["id"]: r["text"] for r in rows} and dead.count() == 0


def test_folders_odd_elements_and_empty_arrays(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for name, text in (("a", "[]"), ("b", " [ ] "), ("c", '[{"id": 1}, 5, {"id": "x"}, {"id": 2}]'), ("d", ""), ("e", '[\n{"id": 3}\n]')):
        (tmp_path / f"f/{name}.json").write_text(text)
    found, dead = read_array(spark, str(tmp_path / "f"), "id BIGINT", split=3)
    assert sorted(r.id for r in found.collect()) == [1, 2, 3]
    assert sorted(r.raw for r in dead.collect()) == ["5", '{"id": "x"}']
    (tmp_path / "object.json").write_text('{"id": 1}')
    (tmp_path / "short.json").write_text('[{"id": 1}, {"id": 2')
    for name, message in (("object", "no JSON array"), ("short", "ends inside")):
        with pytest.raises(Exception, match=message):
            read_array(spark, str(tmp_path / f"{name}.json"), "id BIGINT")[0].collect()


def _scenes(folder, frames=2, name="scene-0001"):
    files = {
        "scene": [{"token": "sc", "name": name}, {"token": "s2", "name": "bad name"}],
        "sample": [{"token": "sa", "scene_token": "sc", "timestamp": 1000}, {"token": "sb", "scene_token": "s2", "timestamp": 5}],
        "sample_data": [
            {"token": f"d{i}", "sample_token": "sa", "ego_pose_token": f"e{i}", "calibrated_sensor_token": "c1", "timestamp": 1001 + i, "fileformat": "jpg", "filename": f"CAM/{i}.jpg"}
            for i in range(frames)
        ]
        + [{"token": "dx", "sample_token": "sb", "ego_pose_token": "e0", "calibrated_sensor_token": "c1", "timestamp": 1, "fileformat": "jpg", "filename": "CAM/0.jpg"}],
        "ego_pose": [{"token": f"e{i}", "timestamp": 1001 + i, "rotation": [1, 0, 0, 0], "translation": [1.5, 2, 3]} for i in range(frames)],
        "calibrated_sensor": [{"token": "c1", "sensor_token": "s1", "rotation": [1, 0, 0, 0], "translation": [0, 0, 1], "camera_intrinsic": []}],
        "sensor": [{"token": "s1", "channel": "CAM_FRONT", "modality": "camera"}],
        "sample_annotation": [],
        "instance": [],
        "category": [],
    }
    folder.mkdir(exist_ok=True)
    (folder / "CAM").mkdir(exist_ok=True)
    for key, rows in files.items():
        (folder / f"{key}.json").write_text(json.dumps(rows, indent=1))
    for i in range(frames):
        (folder / f"CAM/{i}.jpg").write_bytes(b"frame %d" % i)


def test_scene_files_are_cut_once(spark, tmp_path):
    root = tmp_path / "root"
    _scenes(root, frames=3)
    found = read_scenes(spark, str(root), split=64)
    for file in root.glob("*.json"):
        file.unlink()
    assert {name: rows.count() for name, rows in found.items()}["sample_data"] == 4 and "_corrupt_record" not in found["scene"].columns
    _scenes(root)
    (root / "sensor.json").write_text('[{"token": "s1"}, {"token": "s2", "channel": [')
    with pytest.raises(Exception, match="ends inside"):
        read_scenes(spark, str(root), split=64)
    (root / "sensor.json").write_text('[{"token": "s1"}, 7]')
    with pytest.raises(ValueError, match="does not fit: 7"):
        read_scenes(spark, str(root), split=64)


def _actions(result):
    return {r.log_id: r.action for r in result.logs.collect()}


def test_scenes_come_in_once_and_go_back(spark, tmp_path):
    root, store = tmp_path / "root", ParquetStore(spark, str(tmp_path / "lake"))
    _scenes(root)
    first = ingest_scenes(store, str(root), "v1", split=64)
    assert _actions(first) == {"scene-0001": "committed", "bad name": "refused"}
    assert first.rows_written == {"sensor_data": 2, "pose": 2, "calibration": 1, "track": 0, "log": 1}
    rows = active_rows(store, "sensor_data").collect()
    assert {r.byte_size for r in rows} == {7} and all(len(r.checksum) == 64 for r in rows)
    report = reconcile_scenes(store, str(root)).where("log_id = 'scene-0001'").first()
    assert (report.source_total, report.table_total, report.status) == (2, 2, "ok")
    assert _actions(ingest_scenes(store, str(root), "v1"))["scene-0001"] == "unchanged"
    # A payload changes in place: another state, another commit. Then it goes back.
    (root / "CAM/1.jpg").write_bytes(b"frame X")
    assert _actions(ingest_scenes(store, str(root), "v1"))["scene-0001"] == "committed"
    (root / "CAM/1.jpg").write_bytes(b"frame 1")
    again = ingest_scenes(store, str(root), "v1")
    assert _actions(again)["scene-0001"] == "reactivated" and again.rows_written["sensor_data"] == 0
    assert ledgers.commit_ids(store.read("sensor_data")).count() == 2
    # A frame is named whose file is gone.
    (root / "CAM/1.jpg").unlink()
    gone = ingest_scenes(store, str(root), "v1")
    assert _actions(gone)["scene-0001"] == "refused"
    assert {(r.object.rsplit("/", 1)[-1], r.reason) for r in store.quarantine().where("reason = 'file_missing'").collect()} == {("1.jpg", "file_missing")}
    # The gate sees a source that has more than the table.
    _scenes(root, frames=3)
    report = reconcile_scenes(store, str(root)).where("log_id = 'scene-0001'").first()
    assert (report.missing, report.status) == (1, "incomplete")


def _broadcast(df):
    """Names of all columns that the joins of a plan would gather in the driver, to broadcast them."""
    nodes, names = [df._jdf.queryExecution().sparkPlan()], set()
    while nodes:
        node = nodes.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "BroadcastHashJoin":
            side = node.left() if "Left" in node.buildSide().toString() else node.right()
            names |= {side.output().apply(i).name() for i in range(side.output().size())}
        nodes += children
    return names


def test_what_grows_with_the_frames_is_not_broadcast(spark, tmp_path, monkeypatch):
    root, sized = tmp_path / "root", []
    _scenes(root, frames=3)
    monkeypatch.setattr("sensormill.plans.scenes.materialise", lambda df, label: sized.append(df) or materialise(df, label))
    tables = scene_tables(spark, str(root), split=64)
    assert tables["sensor_data"].count() == 4 and len(sized) == 6
    grows = {"sample_token", "instance_token", "timestamp", "source_path"}
    for df in [*sized, scene_keys(spark, str(root))]:
        assert not _broadcast(df) & grows
    assert _broadcast(scene_keys(spark, str(root)))  # sensors still are


def test_work_is_spread_although_rows_come_from_a_grouping(spark):
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    paths = spark.range(1000).select(F.concat(F.lit("p"), "id").alias("path"))
    assert spread(paths.distinct(), "path").select(F.spark_partition_id().alias("n")).distinct().count() == slots
