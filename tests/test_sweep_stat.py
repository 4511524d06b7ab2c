"""The table of sensor checks keeps what the newest version of a check says of a log; Feather trees are scanned by tasks."""

import pyarrow as pa
import pyarrow.feather as feather
from pyspark.sql import types as T

from sensormill.plans import sweep_stat
from sensormill.plans.store import ParquetStore
from sensormill.sources.feather import scan


def test_newer_versions_replace_older_ones_log_by_log(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "stats"), {sweep_stat.TABLE: T.StructType.fromDDL(sweep_stat.DDL)})
    store.ensure_tables()
    assert sweep_stat.current(store).count() == 0

    def measured(*rows):
        return spark.createDataFrame(list(rows), "log_id string, a int, b int")

    both = ["a", "b"]
    assert sweep_stat.record(store, {"pose-1": (measured(("L", 1, 2), ("M", 3, None)), both), "range-9": (measured(("L", 5, 6)), ["a"])}, 10) == 5
    sweep_stat.record(store, {"pose-2": (measured(("L", 10, 20)), ["b"])}, 20)
    sweep_stat.record(store, {"pose-10": (measured(("N", 7, 8)), ["a"])}, 25)
    sweep_stat.record(store, {"pose-1": (measured(("L", 0, 0), ("M", 4, 4)), ["a"])}, 30)
    found = {(r.log_id, r.metric, r.value, r.check_version) for r in sweep_stat.current(store).collect()}
    assert found == {("L", "b", 20.0, "pose-2"), ("M", "a", 4.0, "pose-1"), ("N", "a", 7.0, "pose-10"), ("L", "a", 5.0, "range-9")}
    row = sweep_stat.current(store).where("log_id = 'N'").first()
    assert (row.sensor, row.sweep_ns) == (None, None)


def test_a_feather_tree_is_scanned(spark, tmp_path):
    for folder in ("a", "a/b", "c", "_d"):
        (tmp_path / folder).mkdir()
        feather.write_feather(pa.table({"t": [1, 2], "v": [folder, None]}), str(tmp_path / folder / "x.feather"))
    (tmp_path / "c/notes.txt").write_text("no table")
    rows = scan(spark, str(tmp_path), T.StructType.fromDDL("v STRING, missing INT, t BIGINT")).collect()
    assert sorted((r.row_index, r.t, str(r.v), r.missing) for r in rows) == sorted([(0, 1, f, None) for f in ("a", "a/b", "c", "_d")] + [(1, 2, "None", None)] * 4)
    assert scan(spark, str(tmp_path / "none"), T.StructType.fromDDL("t BIGINT")).count() == 0
