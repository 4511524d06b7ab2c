"""One stream, two tables: envelopes that parse, and dead letters in the quarantine of the store, visible together.

A batch writes its rows and its dead letters under its own id, each replacing what an earlier try left, and then one
marker. Readers go by the markers, so of a batch that died they see nothing, and after it has run again everything once.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.streaming.replay import parse_envelopes
from sensormill.streaming.sinks import BATCH, read_batches, write_batch

_MARKER = T.StructType([T.StructField("n_rows", T.LongType()), T.StructField("n_dead", T.LongType())])


class EnvelopeSink:
    """A sink for rows (id, topic, value) whose value is the JSON text of an envelope with the fields ``ddl``.

    Dead letters go to the store's quarantine, where failed files and gates are as well: the topic as log, the id as
    object, the raw text as detail. ``name`` tells the streams of a store apart.
    """

    def __init__(self, store, path: str, name: str, ddl: str, key: str = "event_id", topic: str = "topic", value: str = "value"):
        self.store, self.path, self.name, self.ddl = store, path.rstrip("/"), name, ddl
        self.key, self.topic, self.value = key, topic, value

    def append_id(self, batch_id):
        """Where the quarantine keeps the dead letters of a batch; below zero, apart from appends of an ingest."""
        return -((zlib.crc32(self.name.encode()) << 31) + batch_id + 1)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows.persist()  # two writes, one read of the source
        try:
            good, dead = parse_envelopes(rows, self.value, self.ddl)
            write_batch(good, f"{self.path}/rows", batch_id)
            letters = dead.select(
                F.col(self.topic).alias("log_id"), F.col(self.key).cast("string").alias("object"),
                F.concat(F.lit("envelope_"), "reason").alias("reason"), F.col("raw").alias("detail"),
            )
            self.store.replace_quarantine(letters, self.append_id(batch_id))
            self.mark(rows.sparkSession.range(1).select(F.lit(good.count()).alias("n_rows"), F.lit(dead.count()).alias("n_dead")), batch_id)
        finally:
            rows.unpersist()

    def mark(self, marker: DataFrame, batch_id: int) -> None:
        write_batch(marker, f"{self.path}/markers", batch_id)

    def markers(self) -> DataFrame:
        return read_batches(self.store.spark, f"{self.path}/markers", _MARKER)

    def rows(self, schema: T.StructType) -> DataFrame:
        """Envelopes of finished batches: the other columns of the stream and the envelope's fields."""
        found = read_batches(self.store.spark, f"{self.path}/rows", schema)
        return found.join(self.markers().select(BATCH), BATCH, "left_semi").drop(BATCH)

    def dead(self) -> DataFrame:
        """Dead letters of finished batches, as they stand in the quarantine."""
        ids = self.markers().select((-(F.lit(zlib.crc32(self.name.encode()) << 31) + F.col(BATCH) + 1)).alias("append_id"))
        return self.store.quarantine_appends().join(ids, "append_id", "left_semi").drop("append_id")
