"""Sinks that may run a batch again. Every batch owns the partition of its id, so a repeated batch replaces itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators.joins import join_null_safe
from sensormill.operators.releases import newest_states, stale_events
from sensormill.workspace import read_if_there

BATCH = "stream_batch_id"
Sink = Callable[[DataFrame, int], None]


#: Folder of the day a row's event lies on, where a table is cut by days as well.
DAY, DAY_NS = "event_day", 86_400_000_000_000


def write_batch(rows: DataFrame, path: str, batch_id: int, time_ns: str | None = None) -> None:
    """Write a batch in place of an earlier try. With ``time_ns`` its rows are also laid out by the day of that time."""
    tagged, parts = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")), [BATCH]
    if time_ns is not None:
        tagged, parts = tagged.withColumn(DAY, _day(F.col(time_ns))), [DAY, BATCH]
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _day(time_ns: Column) -> Column:
    return F.floor(time_ns / F.lit(DAY_NS)).cast("bigint")


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, since_ns: int | None = None
) -> DataFrame:
    """Rows written so far, with their batch id; none if nothing has been written. ``before`` excludes later batches.

    ``since_ns`` opens only folders of that day and later ones, in a table that is laid out by days; rows without a time
    are in none of them.
    """
    full = T.StructType([*(f for f in schema.fields if f.name not in (BATCH, DAY)), T.StructField(BATCH, T.LongType())])
    days = T.StructType([*full.fields, T.StructField(DAY, T.LongType())])
    rows = read_if_there(spark, full if since_ns is None else days, path)
    if rows is None:
        return spark.createDataFrame([], full)
    if since_ns is not None:
        rows = rows.where(F.col(DAY) >= since_ns // DAY_NS)
    return (rows if before is None else rows.where(F.col(BATCH) < before)).select(*full.fieldNames())


def append_batches(path: str) -> Sink:
    return lambda rows, batch_id: write_batch(rows, path, batch_id)


def append_new(path: str, keys: Sequence[str]) -> Sink:
    """Append rows whose key no earlier batch has, once each.

    It reads the keys of all earlier batches, so a stream that lives long should drop duplicates by key first, with the
    keys in Spark's state store, and use ``append_batches``.
    """

    def sink(rows: DataFrame, batch_id: int) -> None:
        known = read_batches(rows.sparkSession, path, rows.schema, before=batch_id).select(*keys)
        write_batch(join_null_safe(rows.dropDuplicates([*keys]), known, keys, "left_anti"), path, batch_id)

    return sink


def keep_if_newer(path: str, key: str = "release_id", version: str = "version") -> Sink:
    """History of states: events not newer than what is held are dropped, whatever order they come in."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        history = read_batches(rows.sparkSession, path, rows.schema, before=batch_id).drop(BATCH)
        newest = newest_states(rows, key, version).select(*rows.columns)
        stale = stale_events(newest, newest_states(history, key, version), key, version)
        fresh = newest.join(stale.select(key), key, "left_anti").select(*rows.columns)
        write_batch(fresh, path, batch_id)

    return sink


def split_late(
    path: str, late_path: str, marks_path: str, time_ns: str, event_id: str, delay_ns: int
) -> Sink:
    """Divide each batch at a fixed distance behind the high-water mark, and drop repeated event ids.

    Spark drops late rows of stateful operators without a trace. Here lateness is decided first, against the greatest
    event time of earlier batches, and late rows go to quarantine. A repetition carries the event time of its original,
    so an on-time row can only repeat rows behind the same limit: the look-back is bounded by the delay. The table is laid
    out by days of event time, so the look-back opens the folders of those days and no others.
    """
    marks = T.StructType([T.StructField("mark_ns", T.LongType())])

    def sink(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        mark = read_batches(spark, marks_path, marks, before=batch_id).agg(F.max("mark_ns")).first()[0]
        limit = F.lit(None if mark is None else mark - delay_ns).cast("bigint")
        late = F.coalesce(F.col(time_ns) < limit, F.lit(False))
        since = None if mark is None else mark - delay_ns
        recent = read_batches(spark, path, rows.schema, before=batch_id, since_ns=since)
        if since is not None:
            recent = recent.where(F.col(time_ns) >= since)
        rows.persist()  # three writes, one read of the source
        try:
            write_batch(rows.where(late), late_path, batch_id)
            on_time = rows.where(~late).dropDuplicates([event_id])
            fresh = on_time.join(recent.select(event_id), event_id, "left_anti").select(*rows.columns)
            write_batch(fresh, path, batch_id, time_ns)
            write_batch(rows.agg(F.max(time_ns).alias("mark_ns")).where("mark_ns IS NOT NULL"), marks_path, batch_id)
        finally:
            rows.unpersist()

    return sink


def run_available(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop; started again with the same checkpoint, it goes on from there."""
    started = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    try:
        started.awaitTermination()
    finally:
        started.stop()
