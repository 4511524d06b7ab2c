"""State kept per key by the stream itself, so that a batch costs what it brings and no earlier output is read."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HELD = T.StructType([T.StructField("version", T.LongType()), T.StructField("timer_ms", T.LongType())])


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state lives in RocksDB, on the executors' disks and in the checkpoint; other stores cannot hold it."""
    spark.conf.set(_PROVIDER, _ROCKS)


class _Newest(StatefulProcessor):
    """Holds the greatest version per key and lets only newer ones pass."""

    def __init__(self, names: list[str], key: str, version: str, time: str | None, keep_ms: int | None):
        self.names, self.key, self.version, self.time, self.keep_ms = names, key, version, time, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _HELD)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        best, latest = None, None
        for row in rows:
            if row[self.version] is None:
                continue
            if best is None or self._order(row) > self._order(best):
                best = row
            if self.time is not None and row[self.time] is not None:
                at = int(row[self.time].timestamp() * 1000)
                latest = at if latest is None else max(latest, at)
        if best is None:
            return
        version, timer = self.held.get() if self.held.exists() else (None, None)
        if self.keep_ms is not None and latest is not None:
            until = max(latest + self.keep_ms, timerValues.getCurrentWatermarkInMs() + 1)
            if timer is None or until > timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(until)
                timer = until
        newer = version is None or best[self.version] > version
        self.held.update((best[self.version] if newer else version, timer))
        if newer:
            yield Row(**{n: best[n] for n in self.names})

    def _order(self, row: Row) -> tuple:
        """Version first; among equal ones the same row wins in whatever order they come."""
        return (row[self.version], *(str(row[n]) for n in self.names))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def newer_versions(
    stream: DataFrame, key: str = "release_id", version: str = "version", time: str | None = None, keep_ms: int | None = None
) -> DataFrame:
    """The events that are newer than all earlier ones of their key; of a batch the newest per key.

    The greatest version per key is the stream's own state: an event is compared with it and with nothing else, however
    long the history is. A batch that runs again starts from the state before it, so it decides the same.

    Without ``time`` a key is remembered for ever. With the event time ``time`` (the stream needs a watermark on it) and
    ``keep_ms``, a timer forgets a key once the watermark has passed its last event by that much. Whatever is older than
    the watermark is dropped by Spark before it gets here, so a stale event cannot come back through a forgotten key as
    long as versions grow with time. Events without a version are dropped; equal versions are not newer.
    """
    if keep_ms is not None and time is None:
        raise ValueError("forgetting keys needs an event time")
    use_keyed_state(stream.sparkSession)
    names = stream.columns
    processor = _Newest(names, key, version, time, keep_ms)
    typed = stream.withColumn(version, F.col(version).cast("bigint"))
    return typed.groupBy(key).transformWithState(processor, typed.schema, "append", "eventTime" if keep_ms is not None else "none")
