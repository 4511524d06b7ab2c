"""Event-time streams over replayed sensor events, and their comparison with the batch tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators.multiset import row_differences, same_rows


def replay(
    spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet", **options: str
) -> DataFrame:
    """The replayed events. ``source`` may name another stream source of the session, such as ``kafka``."""
    return spark.readStream.format(source).schema(schema).options(**options).load(path)


def event_time(ns: Column) -> Column:
    """Watermarks need a timestamp; the nanoseconds stay in their own column."""
    return F.timestamp_micros(F.floor(ns / 1000).cast("bigint"))


def without_repeats(stream: DataFrame, time: str, event_id: str, delay: str) -> DataFrame:
    """Each event id once while the watermark allows a repetition.

    The producer's id decides, never the content: the batch table keeps rows that are equal by right.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([event_id])


def window_counts(stream: DataFrame, time: str, keys: Sequence[str], width: str, delay: str) -> DataFrame:
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    start_ns = F.unix_micros(F.col("_w.start")) * 1000
    return counted.select(start_ns.alias("window_ns"), *keys, "n_events")


def parsed_envelopes(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """The rows with ``_e``, their parsed envelope, and ``_dead``: truncated and mistyped JSON are dead letters."""
    schema = f"{ddl}, _corrupt_record STRING"
    parsed = df.withColumn(
        "_e", F.from_json(F.col(column), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    )
    return parsed.withColumn("_dead", F.col("_e").isNull() | F.col("_e._corrupt_record").isNotNull())


def parse_envelopes(df: DataFrame, column: str, ddl: str) -> tuple[DataFrame, DataFrame]:
    """(envelopes with their fields, dead letters with the raw text). Truncated and mistyped JSON are dead letters."""
    parsed = parsed_envelopes(df, column, ddl)
    others = [c for c in df.columns if c != column]
    good = parsed.where("NOT _dead").select(*others, "_e.*").drop("_corrupt_record")
    return good, parsed.where("_dead").select(*others, F.col(column).alias("raw"), F.lit("malformed").alias("reason"))


def equivalence(batch: DataFrame, streamed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whether both tables hold the same rows with the same multiplicity, over columns fixed beforehand."""
    return same_rows(batch, streamed, columns)


def equivalence_differences(batch: DataFrame, streamed: DataFrame, columns: Sequence[str]) -> DataFrame:
    return row_differences(batch, streamed, columns)
