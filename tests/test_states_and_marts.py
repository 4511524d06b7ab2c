"""Keyed state of streams, and the mart that is updated by change sets."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators.gates import evaluate_gates, gate_mart
from sensormill.plans.mart import GateMart
from sensormill.plans.reconcile import active_rows
from sensormill.plans.store import ParquetStore
from sensormill.streaming import replay, sinks, states

EVENTS = "release_id string, version bigint, state string, s bigint"


class Releases:
    """Events arrive as files; every run takes what is there through the same checkpoint."""

    def __init__(self, spark, folder, keep_ms=None):
        self.spark, self.folder, self.keep_ms = spark, str(folder), keep_ms
        self.schema = spark.createDataFrame([], EVENTS).withColumn("at", F.timestamp_seconds("s")).drop("s").schema

    def arrive(self, *rows):
        events = self.spark.createDataFrame(list(rows), EVENTS).withColumn("at", F.timestamp_seconds("s")).drop("s")
        events.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def run(self, sink=None):
        stream = replay.replay(self.spark, f"{self.folder}/in", self.schema)
        if self.keep_ms is not None:
            stream = stream.withWatermark("at", "10 seconds")
        newer = states.newer_versions(stream, time="at" if self.keep_ms is not None else None, keep_ms=self.keep_ms)
        sinks.run_available(newer, sink or sinks.append_batches(f"{self.folder}/out"), f"{self.folder}/checkpoint")

    def history(self):
        rows = sinks.read_batches(self.spark, f"{self.folder}/out", self.schema).collect()
        return sorted((r.release_id or "", r.version, r.state) for r in rows)


def test_only_newer_versions_pass_and_restarts_remember(spark, tmp_path):
    releases = Releases(spark, tmp_path)
    releases.arrive(("r", 2, "gated", 1), ("r", 1, "draft", 1), (None, 7, "no key", 1), ("v", None, "no version", 1))
    releases.run()
    releases.arrive(("r", 1, "draft", 2), ("r", 2, "again", 2), ("s", 1, "draft", 2), (None, 6, "older", 2))
    releases.run()  # a new query on the old checkpoint: what it knows comes from its state
    releases.arrive(("r", 3, "approved", 3))
    releases.run()
    assert releases.history() == [("", 7, "no key"), ("r", 2, "gated"), ("r", 3, "approved"), ("s", 1, "draft")]


def test_a_batch_that_runs_again_decides_the_same_and_reads_no_earlier_output(spark, tmp_path):
    releases = Releases(spark, tmp_path)
    releases.arrive(("r", 2, "gated", 1))
    releases.run()
    # Without the files of earlier batches nothing changes: the stream does not look at them.
    for file in (tmp_path / "out").rglob("*.parquet"):
        file.write_bytes(b"")
    write, runs = sinks.append_batches(f"{tmp_path}/later"), []

    def dies_once(rows, batch_id):
        write(rows, batch_id)
        runs.append(batch_id)
        if len(runs) == 1:
            raise RuntimeError("consumer killed")

    releases.arrive(("r", 1, "stale", 2), ("r", 3, "approved", 2))
    with pytest.raises(Exception, match="killed"):
        releases.run(dies_once)
    releases.run(dies_once)
    assert runs == [1, 1]
    rows = sinks.read_batches(spark, f"{tmp_path}/later", releases.schema).collect()
    assert [(r.release_id, r.version, r.stream_batch_id) for r in rows] == [("r", 3, 1)]


def test_a_key_is_forgotten_once_the_watermark_has_passed_it(spark, tmp_path):
    releases = Releases(spark, tmp_path, keep_ms=20_000)
    releases.arrive(("r", 5, "gated", 100))
    releases.run()
    releases.arrive(("r", 4, "stale", 110), ("s", 1, "draft", 125))  # the watermark goes to 115: r is still known
    releases.run()
    assert releases.history() == [("r", 5, "gated"), ("s", 1, "draft")]
    releases.arrive(("s", 2, "gated", 1000))
    releases.run()
    releases.arrive(("r", 4, "late", 101), ("r", 1, "anew", 1001))  # one is behind the watermark, one meets no state
    releases.run()
    assert releases.history() == [("r", 1, "anew"), ("r", 5, "gated"), ("s", 1, "draft"), ("s", 2, "gated")]
    with pytest.raises(ValueError, match="event time"):
        states.newer_versions(spark.readStream.format("rate").load().withColumnRenamed("value", "version"), key="version", keep_ms=1)


ROWS = "log_id string, ingest_commit_id string, lang string, n int"


def _outcomes(rows):
    return evaluate_gates(rows, {"big": F.col("n") > 1, "blind": F.lit(None).cast("boolean")}, ["log_id", "ingest_commit_id", "lang"])


class Lake:
    def __init__(self, spark, folder):
        self.spark = spark
        self.store = ParquetStore(spark, f"{folder}/lake", {"results": T.StructType.fromDDL(ROWS)})
        self.store.ensure_tables()
        self.mart = GateMart(self.store, f"{folder}/mart", "results", _outcomes, ["gate", "lang"])

    def ingest(self, append_id, *rows):
        if rows:
            self.store.append("results", self.spark.createDataFrame(list(rows), ROWS), append_id)
            self.activate(append_id, *{(r[0], r[1]) for r in rows})

    def activate(self, append_id, *commits):
        ledger = [(append_id, log, commit, commit, "v1") for log, commit in commits]
        ddl = "seq bigint, log_id string, commit_id string, source_digest string, transform_version string"
        self.store.append_ledger(self.spark.createDataFrame(ledger, ddl), append_id)

    def check(self):
        whole = gate_mart(_outcomes(active_rows(self.store, "results")), ["gate", "log_id", "lang"])
        kept = self.mart.rolled_up(["gate", "log_id", "lang"])
        assert sorted(map(str, kept.select(whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_mart_follows_the_active_commits(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    assert lake.mart.update().update_id is None
    lake.ingest(1, ("a", "a1", "en", 1), ("a", "a1", None, 2), ("b", "b1", "en", 2), ("b", "b1", "en", 2))
    first = lake.mart.update()
    assert (first.n_logs, first.n_read, first.n_outcomes) == (2, 2, 8)
    lake.check()
    assert lake.mart.update().update_id is None  # nothing new
    lake.ingest(2, ("a", "a2", "de", 5))
    second = lake.mart.update()
    assert (second.n_logs, second.n_read, second.n_outcomes) == (1, 1, 2)  # b is not looked at
    lake.check()
    assert {(r.log_id, r.lang) for r in lake.mart.per_log().collect()} == {("a", "de"), ("b", "en")}
    for state, append_id in (("a1", 3), ("a2", 4), ("a1", 5)):  # back and forth, from the mart's own counts
        lake.activate(append_id, ("a", state))
        again = lake.mart.update()
        assert (again.n_logs, again.n_read, again.n_outcomes) == (1, 0, 0)
        lake.check()


def test_an_update_that_died_does_not_count(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path)
    lake.ingest(1, ("a", "a1", "en", 1))
    lake.mart.update()
    lake.ingest(2, ("a", "a2", "en", 3), ("c", "c1", "fr", 0))
    write = lake.mart._write

    def dies(name, rows, update_id):
        if name == "updates":
            raise RuntimeError("killed")
        write(name, rows, update_id)

    monkeypatch.setattr(lake.mart, "_write", dies)
    with pytest.raises(RuntimeError, match="killed"):
        lake.mart.update()
    assert [(r.log_id, r.gate, r.passed) for r in lake.mart.per_log().where("gate = 'big'").collect()] == [("a", "big", 0)]
    monkeypatch.setattr(lake.mart, "_write", write)
    assert lake.mart.update().n_logs == 2
    lake.check()


def test_a_commit_without_rows_takes_its_log_out(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.ingest(1, ("a", "a1", "en", 1))
    lake.mart.update()
    lake.activate(2, ("a", "a2"))
    assert (lake.mart.update().n_logs, lake.mart.per_log().count()) == (1, 0)
