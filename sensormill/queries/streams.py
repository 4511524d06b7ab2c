"""Streaming queries. Each replays whole tables through Structured Streaming and returns the final table."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.functions.timing import epoch_ns
from sensormill.operators.joins import last_per_key
from sensormill.operators.releases import newest_states
from sensormill.plans.store import ParquetStore
from sensormill.queries.registry import EVENT_FRAMES_SQL, event_frames, query, table
from sensormill.queries.timelines import DAY_NS
from sensormill.streaming import replay, sinks, states
from sensormill.streaming.envelopes import EnvelopeSink
from sensormill.workspace import fresh_path

COLUMNS = ["event_id", "user_id", "event_type", "timestamp_ns", "value", "props"]
# Wide enough for the whole replayed range: the delay is part of the comparison, fixed before the run.
DELAY = "60 days"


def _event_rows(events: DataFrame) -> DataFrame:
    return events.withColumn("timestamp_ns", epoch_ns(events, "ts")).select(*COLUMNS)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # As a glob the path may be one file or a folder of files; a plain path must be a folder.
    schema = table(spark, folder, "events").schema
    rows = _event_rows(replay.replay(spark, f"{folder}/events.parque[t]", schema))
    return rows.withColumn("event_time", replay.event_time(F.col("timestamp_ns")))


def _replayed_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is delivered twice; the sink's table holds it once."""
    out = fresh_path(spark, "replayed")
    twice = _event_stream(spark, folder).union(_event_stream(spark, folder))
    once = replay.without_repeats(twice, "event_time", "event_id", DELAY).select(*COLUMNS)
    sinks.run_available(once, sinks.append_batches(f"{out}/table"), f"{out}/checkpoint")
    return sinks.read_batches(spark, f"{out}/table", once.schema)


@query("SELECT event_id, user_id, event_type, epoch_ns(ts) AS timestamp_ns, value, props FROM events")
def stream_table(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed_twice(spark, folder).select(*COLUMNS)


@query(
    """SELECT 'once' AS streamed, count(*) AS left_rows, count(*) AS right_rows, TRUE AS same FROM events
UNION ALL SELECT 'twice', count(*), 2 * count(*), count(*) = 0 FROM events
UNION ALL SELECT 'other value', count(*), count(*), count(*) FILTER (event_type = 'error') = 0 FROM events"""
)
def stream_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The streamed table equals the batch table; with its duplicates left in, or with other values, it must not."""
    batch, streamed = _event_rows(table(spark, folder, "events")), _replayed_twice(spark, folder).select(*COLUMNS)
    changed = F.when(F.col("event_type") == "error", F.coalesce(F.col("value"), F.lit(0.0)) + 1).otherwise(F.col("value"))
    cases = {"once": streamed, "twice": streamed.unionByName(streamed), "other value": streamed.withColumn("value", changed)}
    rows = [replay.equivalence(batch, rows, COLUMNS).select(F.lit(name).alias("streamed"), "*") for name, rows in cases.items()]
    return reduce(DataFrame.unionByName, rows)


@query(
    """SELECT (epoch_ns(ts) // 3600000000000) * 3600000000000 AS window_ns, event_type, count(*) AS n_events
FROM events GROUP BY ALL"""
)
def stream_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly counts in update mode: of the states a window went through, the newest batch's holds."""
    out = fresh_path(spark, "windows")
    counts = replay.window_counts(_event_stream(spark, folder), "event_time", ["event_type"], "1 hour", DELAY)
    sinks.run_available(counts, sinks.append_batches(f"{out}/table"), f"{out}/checkpoint", mode="update")
    written = sinks.read_batches(spark, f"{out}/table", counts.schema)
    return last_per_key(written, ["window_ns", "event_type"], [sinks.BATCH]).drop(sinks.BATCH)


STAGES = 4
_LATE_AFTER_NS = 10 * DAY_NS


@query(
    f"""WITH {EVENT_FRAMES_SQL}, f AS (SELECT event_id, timestamp_ns, k // 25 AS stage FROM frames),
m AS (SELECT stage, max(timestamp_ns) AS mark FROM f GROUP BY stage)
SELECT event_id, coalesce(timestamp_ns < (SELECT max(mark) FROM m WHERE m.stage < f.stage) - {_LATE_AFTER_NS}, FALSE)
  AS late FROM f"""
)
def stream_late_split(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive in four stages by k, each twice; what lies far behind the high-water mark is set apart."""
    out = fresh_path(spark, "late")
    rows = event_frames(spark, folder).select("event_id", "timestamp_ns", F.floor(F.col("k") / 25).alias("stage"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("timestamp_ns", T.LongType())])
    sink = sinks.split_late(f"{out}/table", f"{out}/late", f"{out}/marks", "timestamp_ns", "event_id", _LATE_AFTER_NS)
    for stage in range(STAGES):
        arriving = rows.where(F.col("stage") == stage).drop("stage")
        arriving.unionByName(arriving).write.mode("append").parquet(f"{out}/arrivals")
        sinks.run_available(replay.replay(spark, f"{out}/arrivals", schema), sink, f"{out}/checkpoint")
    late = sinks.read_batches(spark, f"{out}/late", schema).select("event_id").distinct()
    kept = sinks.read_batches(spark, f"{out}/table", schema).select("event_id")
    return kept.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


@query(
    """SELECT o_custkey AS release_id, max(o_orderkey) AS version, arg_max(o_orderstatus, o_orderkey) AS state
FROM orders GROUP BY o_custkey"""
)
def stream_release_states(spark: SparkSession, folder: str) -> DataFrame:
    """Release events in three waves by status; within and across waves only newer versions count.

    The newest version per release is the stream's own state: a wave is compared with it, not with the history.
    """
    out = fresh_path(spark, "releases")
    events = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("release_id"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("state")
    )
    for state in ("P", "O", "F"):
        events.where(F.col("state") == state).write.mode("append").parquet(f"{out}/events")
        newer = states.newer_versions(replay.replay(spark, f"{out}/events", events.schema))
        sinks.run_available(newer, sinks.append_batches(f"{out}/history"), f"{out}/checkpoint")
    return newest_states(sinks.read_batches(spark, f"{out}/history", events.schema).drop(sinks.BATCH))


@query("SELECT DISTINCT sha256(text) AS checksum FROM documents")
def stream_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads to process, once each: documents arrive by language, and copies across languages and waves."""
    out = fresh_path(spark, "arrivals")
    rows = table(spark, folder, "documents").select(F.sha2("text", 256).alias("checksum"), "lang")
    for german in (True, False):
        rows.where((F.col("lang") == "de") == german).select("checksum").write.mode("append").parquet(f"{out}/in")
        stream = replay.replay(spark, f"{out}/in", rows.select("checksum").schema)
        once = stream.dropDuplicates(["checksum"])  # known keys live in the state store: a batch costs what it brings
        sinks.run_available(once, sinks.append_batches(f"{out}/registered"), f"{out}/checkpoint")
    return sinks.read_batches(spark, f"{out}/registered", rows.select("checksum").schema).select("checksum")


@query(
    """SELECT DISTINCT source FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE quality = 0"""
)
def stream_promotions(spark: SparkSession, folder: str) -> DataFrame:
    """Failing quality rows of a stream promote their slice into the next dataset version, once each."""
    out = fresh_path(spark, "promotions")
    results = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    results.select("source", "quality").write.parquet(f"{out}/quality")
    schema = results.select("source", "quality").schema
    failing = replay.replay(spark, f"{out}/quality", schema).where("quality = 0").select("source")
    once = failing.dropDuplicates(["source"])
    sinks.run_available(once, sinks.append_batches(f"{out}/promoted"), f"{out}/checkpoint")
    return sinks.read_batches(spark, f"{out}/promoted", failing.schema).select("source")


@query(
    """WITH e AS (SELECT 'events' AS topic, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) >= 90
    THEN substr(props, 1, length(props) - 1) ELSE props END AS envelope FROM events
  UNION ALL SELECT 'conversations', text FROM conversations)
SELECT topic, coalesce(CASE WHEN json_valid(envelope) THEN json_type(envelope) = 'OBJECT' END, FALSE) AS good,
  count(*) AS n_envelopes FROM e GROUP BY ALL"""
)
def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes of two topics, some truncated and some no JSON at all."""
    raw = table(spark, folder, "events").select(F.lit("events").alias("topic"), "props", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    cut = F.when(F.col("k") >= 90, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    envelopes = raw.select("topic", cut.alias("envelope")).unionByName(
        table(spark, folder, "conversations").select(F.lit("conversations").alias("topic"), F.col("text").alias("envelope"))
    )
    good, dead = replay.parse_envelopes(envelopes, "envelope", "k BIGINT")
    both = good.select("topic", F.lit(True).alias("good")).unionByName(dead.select("topic", F.lit(False).alias("good")))
    return both.groupBy("topic", "good").agg(F.count(F.lit(1)).alias("n_envelopes"))


_ENVELOPES = """e AS (SELECT event_id, event_type AS topic, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, props FROM events),
v AS (SELECT *, CASE WHEN k >= 90 THEN substr(props, 1, length(props) - 1) WHEN k < 5 THEN '{"k": "' || k || ' pieces"}' ELSE props END AS value FROM e)"""


@query(
    f"""WITH {_ENVELOPES} SELECT event_id, topic, CASE WHEN k >= 90 OR k < 5 THEN 'quarantine' ELSE 'rows' END AS held,
  CASE WHEN k >= 90 OR k < 5 THEN value ELSE CAST(k AS VARCHAR) END AS content FROM v"""
)
def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes in two waves, some truncated and some mistyped. The first batch dies before it is done and runs again."""
    out = fresh_path(spark, "envelopes")
    store = ParquetStore(spark, f"{out}/store", {})
    store.ensure_tables()
    events = table(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    cut = F.expr("substring(props, 1, length(props) - 1)")
    mistyped = F.concat(F.lit('{"k": "'), "k", F.lit(' pieces"}'))
    value = F.when(F.col("k") >= 90, cut).when(F.col("k") < 5, mistyped).otherwise(F.col("props"))
    arriving = events.select("event_id", F.col("event_type").alias("topic"), value.alias("value"))
    sink, tries = EnvelopeSink(store, out, "events", "k BIGINT"), []

    class Consumer(EnvelopeSink):
        def mark(self, marker: DataFrame, batch_id: int) -> None:
            tries.append(batch_id)
            if len(tries) == 1:
                raise RuntimeError("the consumer dies here")
            super().mark(marker, batch_id)

    consumer = Consumer(store, out, "events", "k BIGINT")
    for wave in ("click", "view"):
        arriving.where((F.col("topic") == "click") == (wave == "click")).write.mode("append").parquet(f"{out}/in")
        stream = replay.replay(spark, f"{out}/in", arriving.schema)
        for _ in range(2):
            try:
                sinks.run_available(stream, lambda rows, batch: consumer(rows, batch), f"{out}/checkpoint")
                break
            except StreamingQueryException:
                if len(tries) != 1:
                    raise
    schema = T.StructType.fromDDL("event_id BIGINT, topic STRING, k BIGINT")
    good = sink.rows(schema).select("event_id", "topic", F.lit("rows").alias("held"), F.col("k").cast("string").alias("content"))
    dead = sink.dead().select(F.col("object").cast("bigint").alias("event_id"), F.col("log_id").alias("topic"), F.lit("quarantine").alias("held"), F.col("detail").alias("content"))
    return good.unionByName(dead)
