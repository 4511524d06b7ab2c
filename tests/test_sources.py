import ast
import hashlib
import json
from pathlib import Path

from logtree import make_log, write_table
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sensormill.sources.keys as keys_module
from sensormill.functions.paths import folder_name, is_log_id, relative_to, stamp_ns, strip_scheme
from sensormill.operators.multiset import differences, compare, key_counts
from sensormill.sources.feather import read_tables, register
from sensormill.sources.files import list_files, payload_files, payload_listing, probe_files
from sensormill.sources.json_scenes import canonical_scenes, read_scenes
from sensormill.sources.keys import sensor_counts, source_keys


def folders_of(spark, root, *ids):
    return spark.createDataFrame([(i, f"{root}/{i}") for i in ids], "log_id string, root string")


def touch(root, *names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")


def test_keys_come_from_stamped_files_of_any_suffix(spark, tmp_path):
    touch(
        tmp_path / "L1",
        "sensors/lidar/100.feather",
        "sensors/lidar/README.txt",
        "sensors/lidar/1.tar.gz",
        "sensors/lidar/99999999999999999999.feather",
        "sensors/cameras/ring_front_center/100.jpg",
        "sensors/cameras/ring_front_center/0100.png",
        "sensors/cameras/ring_rear_left/200",
        "sensors/cameras/_odd/7.jpg",
        "sensors/cameras/5.jpg",
        "sensors/cameras/ring_rear_left/300/inner.jpg",
        "annotations/100.feather",
    )
    counted = key_counts(source_keys(folders_of(spark, tmp_path, "L1", "absent")))
    found = {(r.log_id, r.sensor, r.timestamp_ns): r.n for r in counted.collect()}
    assert found == {
        ("L1", "lidar", 100): 1,
        ("L1", "lidar", None): 1,
        ("L1", "ring_front_center", 100): 2,
        ("L1", "ring_rear_left", 200): 1,
        ("L1", "_odd", 7): 1,
    }
    per_sensor = {r.sensor: r.n_frames for r in sensor_counts(source_keys(folders_of(spark, tmp_path, "L1"))).collect()}
    assert per_sensor == {"lidar": 2, "ring_front_center": 2, "ring_rear_left": 1, "_odd": 1}


def test_the_key_side_shares_no_code_with_the_transform():
    tree = ast.parse(Path(keys_module.__file__).read_text())
    imported = {n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)}
    imported |= {a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names}
    assert not any(m and m.startswith("sensormill") for m in imported)


def test_listing_includes_hidden_files_and_probing_skips_absent_ones(spark, tmp_path):
    touch(tmp_path / "L1", "a/_b", ".c", "a/d/e/f/g/h", "top")
    listed = list_files(folders_of(spark, tmp_path, "L1", "none")).select(relative_to(F.col("path"), F.col("root")))
    assert sorted(r[0] for r in listed.collect()) == [".c", "a/_b", "a/d/e/f/g/h", "top"]
    paths = spark.createDataFrame([(f"{tmp_path}/L1/top",), (f"{tmp_path}/L1/gone",)], "source_path string")
    rows = probe_files(paths).collect()
    assert [(r.byte_size, r.checksum) for r in rows] == [(1, hashlib.sha256(b"x").hexdigest())]


def test_payloads_are_hashed_in_the_jvm_and_listings_read_no_content(spark, tmp_path):
    touch(tmp_path, "x/1.jpg", "x/2.png")
    rows = payload_files(spark, str(tmp_path), "*.jpg").collect()
    assert [(r.source_path, r.byte_size, r.checksum) for r in rows] == [
        (f"{tmp_path}/x/1.jpg", 1, hashlib.sha256(b"x").hexdigest())
    ]
    listing = payload_listing(spark, str(tmp_path))
    assert listing.count() == 2
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()


def test_feather_source_and_distributed_read_agree(spark, tmp_path):
    for i in range(3):
        write_table(tmp_path / f"{i}.feather", {"x": list(range(10)), "s": [f"{i}{j}" for j in range(10)], "drop": [0] * 10})
    register(spark)
    schema = T.StructType.fromDDL("x double, s string, absent int")
    full = T.StructType.fromDDL("x double, s string, absent int, row_index bigint, source_path string")
    direct = spark.read.format("feather").schema(full).load(str(tmp_path))
    assert direct.count() == 30 and direct.where("absent IS NOT NULL").count() == 0
    one = spark.read.format("feather").schema(full).load(str(tmp_path / "1.feather")).orderBy("row_index").collect()
    assert [(r.row_index, r.x, r.s) for r in one] == [(j, float(j), f"1{j}") for j in range(10)]
    paths = spark.createDataFrame([(f"L{i}", f"{tmp_path}/{i}.feather") for i in range(3)], "log_id string, path string")
    spread = read_tables(paths, schema)
    assert spread.columns == ["log_id", "row_index", "x", "s", "absent"]
    key = ["x", "s", "row_index"]
    assert differences(compare(direct, spread, key)).count() == 0


def test_path_functions(spark):
    rows = [("file:///a/b/12.jpg",), ("file:/a/b/12",), ("hdfs://n/a/b/1.tar.x",), ("99999999999999999999.x",), ("/a/b/x1.jpg",)]
    df = spark.createDataFrame(rows, "p string")
    p = F.col("p")
    found = df.select(strip_scheme(p).alias("s"), folder_name(p).alias("f"), stamp_ns(p).alias("t")).collect()
    assert [r.s for r in found[:3]] == ["/a/b/12.jpg", "/a/b/12", "hdfs://n/a/b/1.tar.x"]
    assert [r.t for r in found] == [12, 12, None, None, None]
    assert found[0].f == "b"
    ids = [("0bae-3_b",), ("-x",), ("a b",), ("a\n",), ("",), ("../a",), (None,), ("é",)]
    checked = spark.createDataFrame(ids, "i string").select(is_log_id(F.col("i"))).collect()
    assert [r[0] for r in checked] == [True, False, False, False, False, False, False, False]


def test_scene_files_map_onto_the_canonical_tables(spark, tmp_path):
    files = {
        "scene": [{"token": "sc", "name": "scene-0001"}],
        "sample": [{"token": "sa", "scene_token": "sc", "timestamp": 1000}],
        "sample_data": [
            {"token": "d1", "sample_token": "sa", "ego_pose_token": "e1", "calibrated_sensor_token": "c1", "timestamp": 1001, "fileformat": "jpg", "filename": "CAM/1.jpg"},
            {"token": "d2", "sample_token": "sa", "ego_pose_token": "e2", "calibrated_sensor_token": "c2", "timestamp": 1002, "fileformat": "pcd", "filename": "LIDAR/1.pcd"},
        ],
        "ego_pose": [{"token": t, "timestamp": 1001, "rotation": [1, 0, 0, 0], "translation": [1.5, 2, 3]} for t in ("e1", "e2")],
        "calibrated_sensor": [
            {"token": "c1", "sensor_token": "s1", "rotation": [1, 0, 0, 0], "translation": [0, 0, 1], "camera_intrinsic": [[5, 0, 7], [0, 6, 8], [0, 0, 1]]},
            {"token": "c2", "sensor_token": "s2", "rotation": [1, 0, 0, 0], "translation": [0, 0, 2], "camera_intrinsic": []},
        ],
        "sensor": [{"token": "s1", "channel": "CAM_FRONT", "modality": "camera"}, {"token": "s2", "channel": "LIDAR_TOP", "modality": "lidar"}],
        "sample_annotation": [{"sample_token": "sa", "instance_token": "i1", "rotation": [1, 0, 0, 0], "translation": [4, 5, 6], "size": [1, 2, 3], "num_lidar_pts": 9}],
        "instance": [{"token": "i1", "category_token": "k"}],
        "category": [{"token": "k", "name": "vehicle.car"}],
    }
    for name, rows in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=1))
    tables = canonical_scenes(read_scenes(spark, str(tmp_path)), "c")
    sensor = {r.sensor: r for r in tables["sensor_data"].collect()}
    assert sensor["cam_front"].timestamp_ns == 1001000 and sensor["cam_front"].calibration_id == "scene-0001/c1"
    assert sensor["lidar"].calibration_id is None
    calibration = {r.sensor: r for r in tables["calibration"].collect()}
    assert (calibration["cam_front"].fx_px, calibration["cam_front"].cy_px, calibration["lidar"].fx_px) == (5.0, 8.0, None)
    track = tables["track"].first()
    assert (track.length_m, track.width_m, track.num_interior_pts, track.category) == (2.0, 1.0, 9, "vehicle.car")
    assert tables["pose"].count() == 2 and tables["log"].first().end_ns == 1002000


def test_generated_log_has_all_sources(spark, tmp_path):
    make_log(tmp_path, "L1")
    assert source_keys(folders_of(spark, tmp_path, "L1")).count() == 9
