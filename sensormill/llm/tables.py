"""Tables as the operators need them: clean columns, one key per row, text in compressed form for shuffles."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.workspace import materialise

KEY = "_row"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``_row`` (unique, not NULL), ``doc_id`` and ``body`` (UTF-8 bytes; empty for NULL).

    Where the ids are unique and filled, they are the key. Otherwise rows are numbered in order of id (NULL last) in
    a written copy, so that a repeated task sees the same numbers.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).cast("binary").alias("body"))
    ids = rows.groupBy("doc_id").count()
    if ids.filter("count > 1 OR doc_id IS NULL").isEmpty():
        return rows.select(F.col("doc_id").cast("bigint").alias(KEY), "doc_id", "body")
    ordered = rows.orderBy(F.col("doc_id").asc_nulls_last()).withColumn(KEY, F.monotonically_increasing_id())
    return materialise(ordered.select(KEY, "doc_id", "body"), "keyed")


def compressed(rows: DataFrame, *others: str) -> DataFrame:
    """(_row, packed) and the named columns: bodies compressed before they are shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([squeeze(b) for b in batch["body"].to_pylist()], pa.binary())
            columns = [KEY, *others]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), packed], [*columns, "packed"])

    taken = rows.select(KEY, *others, "body")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in taken.schema if f.name != "body")
    return taken.mapInArrow(pack, f"{kinds}, packed binary")


def unpack(value: bytes) -> bytes:
    return zstandard.decompress(value) if value else b""
