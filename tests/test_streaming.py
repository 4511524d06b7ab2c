import pytest
from pyspark.sql import functions as F

from sensormill.streaming import replay, sinks

EVENTS = "event_id bigint, timestamp_ns bigint, v string"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


def add(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    add(events(spark, (1, 10, "a"), (2, 20, "b")), tmp_path / "in")
    schema = events(spark, (1, 1, "")).schema
    stream = replay.replay(spark, str(tmp_path / "in"), schema)
    sink = sinks.append_batches(str(tmp_path / "out"))
    runs = []

    def dies_after_writing(rows, batch_id):
        sink(rows, batch_id)
        runs.append(batch_id)
        if len(runs) == 1:
            raise RuntimeError("consumer killed")

    with pytest.raises(Exception, match="killed"):
        sinks.run_available(stream, dies_after_writing, str(tmp_path / "cp"))
    assert sinks.read_batches(spark, str(tmp_path / "out"), schema).count() == 2  # a reader in between sees them
    sinks.run_available(stream, dies_after_writing, str(tmp_path / "cp"))
    assert runs == [0, 0]
    assert sinks.read_batches(spark, str(tmp_path / "out"), schema).count() == 2
    add(events(spark, (3, 30, "c")), tmp_path / "in")
    sinks.run_available(stream, sink, str(tmp_path / "cp"))
    found = sinks.read_batches(spark, str(tmp_path / "out"), schema)
    assert {(r.event_id, r.stream_batch_id) for r in found.collect()} == {(1, 0), (2, 0), (3, 1)}


def test_duplicates_disorder_and_restarts_end_in_the_batch_table(spark, tmp_path):
    batch = events(spark, (1, 100, "a"), (2, 300, "b"), (3, 200, "b"), (4, 300, "b"))
    schema = batch.schema
    sink = sinks.split_late(*(str(tmp_path / p) for p in ("out", "late", "marks")), "timestamp_ns", "event_id", 1000)
    for part in (batch.where("event_id IN (2, 3)"), batch.where("event_id <> 2"), batch):
        add(part.unionByName(part), tmp_path / "in")
        sinks.run_available(replay.replay(spark, str(tmp_path / "in"), schema), sink, str(tmp_path / "cp"))
    streamed = sinks.read_batches(spark, str(tmp_path / "out"), schema)
    assert replay.equivalence(batch, streamed, batch.columns).first().same
    assert sinks.read_batches(spark, str(tmp_path / "late"), schema).count() == 0
    # (2) and (4) are equal but for their id: rows that repeat by right are kept.
    assert replay.equivalence(batch, streamed, ["timestamp_ns", "v"]).first().same
    # The check itself must be able to fail.
    assert not replay.equivalence(batch, streamed.where("event_id <> 4"), ["timestamp_ns", "v"]).first().same
    differing = replay.equivalence_differences(batch, streamed.where("event_id <> 4"), ["timestamp_ns", "v"]).collect()
    assert [(r.left_n, r.right_n) for r in differing] == [(2, 1)]


def test_late_events_go_to_quarantine_and_a_rerun_decides_the_same(spark, tmp_path):
    schema = events(spark, (1, 1, "")).schema
    paths = [str(tmp_path / p) for p in ("out", "late", "marks")]
    sink = sinks.split_late(*paths, "timestamp_ns", "event_id", 50)
    first, second = events(spark, (1, 100, "a"), (2, 10, "a")), events(spark, (3, 49, "a"), (4, 50, "a"), (1, 100, "a"))
    sink(first, 0)
    for _ in range(2):
        sink(second, 1)
        kept = sinks.read_batches(spark, paths[0], schema)
        late = sinks.read_batches(spark, paths[1], schema)
        assert sorted(r.event_id for r in kept.collect()) == [1, 2, 4]
        assert [(r.event_id, r.stream_batch_id) for r in late.collect()] == [(3, 1)]


def test_watermark_dedup_keeps_rows_equal_by_right(spark, tmp_path):
    add(events(spark, (1, 1000, "a"), (1, 1000, "a"), (2, 1000, "a")), tmp_path / "in")
    schema = events(spark, (1, 1, "")).schema
    stream = replay.replay(spark, str(tmp_path / "in"), schema).withColumn("t", replay.event_time(F.col("timestamp_ns")))
    once = replay.without_repeats(stream, "t", "event_id", "1 hour").select(*schema.fieldNames())
    sinks.run_available(once, sinks.append_batches(str(tmp_path / "out")), str(tmp_path / "cp"))
    assert sorted(r.event_id for r in sinks.read_batches(spark, str(tmp_path / "out"), schema).collect()) == [1, 2]


def test_malformed_envelopes_are_dead_letters(spark):
    raw = ['{"log_id": "L", "n": 1}', '{"log_id": "L", "n": "x"}', '{"log_id": "L"', "", None, '{"n": 2}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "offset int, value string")
    good, dead = replay.parse_envelopes(df, "value", "log_id STRING, n BIGINT")
    assert {(r.offset, r.log_id, r.n) for r in good.collect()} == {(0, "L", 1), (5, None, 2)}
    assert {r.offset for r in dead.collect()} == {1, 2, 3, 4}
    assert good.columns == ["offset", "log_id", "n"] and dead.columns == ["offset", "raw", "reason"]


def test_history_keeps_only_newer_versions(spark, tmp_path):
    path = str(tmp_path / "h")
    ddl = "release_id string, version int, state string"
    sink = sinks.keep_if_newer(path)
    sink(spark.createDataFrame([("r", 2, "gated"), ("r", 1, "draft")], ddl), 0)
    sink(spark.createDataFrame([("r", 1, "draft"), ("s", 1, "draft")], ddl), 1)
    sink(spark.createDataFrame([("r", 3, "approved")], ddl), 2)
    rows = sinks.read_batches(spark, path, spark.createDataFrame([], ddl).schema).collect()
    assert {(r.release_id, r.version, r.stream_batch_id) for r in rows} == {("r", 2, 0), ("s", 1, 1), ("r", 3, 2)}


def test_arrivals_are_registered_once(spark, tmp_path):
    path = str(tmp_path / "a")
    sink = sinks.append_new(path, ["checksum"])
    make = lambda *c: spark.createDataFrame([(x,) for x in c], "checksum string")
    for _ in range(2):
        sink(make("x", "y", "x"), 0)
    sink(make("y", "z", None), 1)
    rows = sinks.read_batches(spark, path, make("x").schema).collect()
    assert sorted((str(r.checksum), r.stream_batch_id) for r in rows) == [("None", 1), ("x", 0), ("y", 0), ("z", 1)]


def test_the_look_back_opens_only_days_behind_the_limit(spark, tmp_path):
    day = sinks.DAY_NS
    paths = [str(tmp_path / p) for p in ("out", "late", "marks")]
    sink = sinks.split_late(*paths, "timestamp_ns", "event_id", day)
    schema = events(spark, (1, 1, "")).schema
    sink(events(spark, (1, 0, "a"), (2, 3 * day, "a"), (3, 5 * day, "a"), (4, -day - 1, "a")), 0)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["event_day=-2", "event_day=0", "event_day=3", "event_day=5"]
    for old in (tmp_path / "out/event_day=0", tmp_path / "out/event_day=3"):
        for file in old.rglob("*.parquet"):
            file.write_bytes(b"unreadable")
    for _ in range(2):
        sink(events(spark, (3, 5 * day, "a"), (5, 4 * day, "b"), (6, 3 * day, "late"), (7, None, "no time")), 1)
    kept = sinks.read_batches(spark, paths[0], schema, since_ns=4 * day).collect()
    assert sorted((r.event_id, r.stream_batch_id) for r in kept) == [(3, 0), (5, 1)]
    assert [(r.event_id, r.stream_batch_id) for r in sinks.read_batches(spark, paths[1], schema).collect()] == [(6, 1)]
