"""Generated log folders in the layout the sources read."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyarrow import feather

POSE = ("qw", "qx", "qy", "qz", "tx_m", "ty_m", "tz_m")


def write_table(path: Path, columns: dict) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    feather.write_feather(pa.table(columns), str(path), chunksize=4)


def make_log(root: Path, log_id: str, cameras=("ring_front_center", "ring_side_left"), frames: int = 3) -> Path:
    folder = root / log_id
    lidar = folder / "sensors" / "lidar"
    lidar.mkdir(parents=True)
    for i in range(frames):
        (lidar / f"{100 + 100 * i}.feather").write_bytes(f"{log_id} sweep {i}".encode())
    for camera in cameras:
        place = folder / "sensors" / "cameras" / camera
        place.mkdir(parents=True)
        for i in range(frames):
            (place / f"{103 + 100 * i}.jpg").write_bytes(f"{log_id} {camera} {i}".encode())
    n = 6
    pose = {c: [float(i) for i in range(n)] for c in POSE}
    write_table(folder / "city_SE3_egovehicle.feather", {"timestamp_ns": list(range(100, 100 + n)), **pose, "unused": ["x"] * n})
    names = [*cameras, "up_lidar", cameras[0]]
    write_table(
        folder / "calibration" / "egovehicle_SE3_sensor.feather",
        {"sensor_name": names, **{c: [float(i) for i in range(len(names))] for c in POSE}},
    )
    write_table(
        folder / "calibration" / "intrinsics.feather",
        {"sensor_name": [*cameras, "unmounted"], **{c: [1.0 + i for i in range(len(cameras) + 1)] for c in ("fx_px", "fy_px", "cx_px", "cy_px")}},
    )
    write_table(
        folder / "annotations.feather",
        {
            "timestamp_ns": [100, 100, 200],
            "track_uuid": ["a", "b", "a"],
            "category": ["PEDESTRIAN", "BUS", "PEDESTRIAN"],
            **{c: [1.0, 2.0, 3.0] for c in ("length_m", "width_m", "height_m", *POSE)},
            "num_interior_pts": [7, 8, 9],
        },
    )
    return folder
