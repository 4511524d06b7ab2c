"""Intermediate tables go when their block ends."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sensormill import workspace
from sensormill.operators.sweeps import capture_intervals
from sensormill.queries.releases import table_file_health
from sensormill.workspace import materialise, scratch, write_unsorted


@pytest.fixture
def shared(monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "workspace", lambda spark: f"file://{tmp_path}")
    return tmp_path


def test_nothing_is_left_after_a_block(spark, shared):
    rows = spark.range(50).select(F.lit("L").alias("log_id"), F.lit("s").alias("sensor"), F.col("id").alias("timestamp_ns"))
    kept = materialise(rows, "outside")
    with scratch(spark):
        assert capture_intervals(kept).where("interval_ns = 1").count() == 49
        assert len(list(shared.iterdir())) > 1
    assert [p.name.split("-")[0] for p in shared.iterdir()] == ["outside"] and kept.count() == 50


def test_nothing_is_left_after_a_failure(spark, shared):
    with pytest.raises(Exception, match="here"), scratch(spark):
        materialise(spark.range(3), "half")
        materialise(spark.range(3).select(F.raise_error(F.lit("it fails here"))), "broken")
    assert list(shared.iterdir()) == []
    with scratch(spark):  # nested use ends with the inner block
        with scratch(spark):
            materialise(spark.range(3), "inner")
        assert list(shared.iterdir()) == []


def test_laying_out_a_table_opens_its_files_at_once(spark, tmp_path, monkeypatch):
    """A task that holds a large folder would sort all of it first."""
    rows = [(i, "NRA"[i % 3], "OF"[i % 2]) for i in range(600)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(name, None)

    def watched(self, path, *args, **kwargs):
        seen.append(spark.conf.get(name, None))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    assert table_file_health(spark, str(tmp_path)).first() == (6, 600)
    assert [int(n or 0) > 1 for n in seen] == [True] and spark.conf.get(name, None) == before
    with pytest.raises(Exception, match="(?i)exists"):
        write_unsorted(spark.range(1).withColumn("k", F.lit(1)), f"{tmp_path}/lineitem.parquet", ["k"])
    assert spark.conf.get(name, None) == before
