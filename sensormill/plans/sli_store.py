"""Stored service levels: each batch adds its sketches and counts under its own id, and replaces only itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators.slis import counted, merged, per_release, sketch, sketch_quantiles, window_of
from sensormill.streaming.sinks import BATCH, read_batches, write_batch


class SliStore:
    """Per slice and time window: a sketch of the lag until rows could be queried, and counts of signals.

    ``slice_`` are the columns that name a slice, such as log_id; a release is a set of slices.
    """

    def __init__(self, spark: SparkSession, path: str, slice_: Sequence[str], window_ns: int):
        self.spark, self.path, self.slice, self.window_ns = spark, path.rstrip("/"), list(slice_), window_ns
        own = [T.StructField(c, T.StringType()) for c in self.slice]
        self.schemas = {
            "lags": T.StructType([*own, *T.StructType.fromDDL("window_ns BIGINT, bucket INT, n BIGINT")]),
            "signals": T.StructType([*own, *T.StructType.fromDDL("window_ns BIGINT, signal STRING, n BIGINT")]),
        }

    def add(self, rows: DataFrame, batch_id: int, emitted_ns: str, queryable_ns: str, signals: dict[str, Column]) -> None:
        """Rows of a batch, windowed by the time they could be queried. The batch may be added again."""
        windowed = rows.withColumns({"window_ns": window_of(F.col(queryable_ns), self.window_ns), "_lag": F.col(queryable_ns) - F.col(emitted_ns)})
        by = [*self.slice, "window_ns"]
        for name, part in (("lags", sketch(windowed, by, "_lag")), ("signals", counted(windowed, by, signals))):
            fitting = part.select(*(F.col(f.name).cast(f.dataType) for f in self.schemas[name]))
            write_batch(fitting, f"{self.path}/{name}", batch_id)

    def _part(self, name: str) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/{name}", self.schemas[name]).drop(BATCH)

    def series(self, percents: Sequence[int] = (50, 95)) -> DataFrame:
        """Per window over all slices: n and percentiles of the lag."""
        return sketch_quantiles(merged(self._part("lags"), ["window_ns"]), ["window_ns"], percents)

    def of_releases(self, members: DataFrame, signals: Sequence[str], percents: Sequence[int] = (50, 95)) -> DataFrame:
        """Per release (release_id, slice): n, percentiles of the lag, and every signal as a count. Nothing else is read."""
        lags = sketch_quantiles(per_release(self._part("lags"), members, self.slice), ["release_id"], percents)
        shown = per_release(self._part("signals"), members, self.slice).groupBy("release_id").agg(
            *(F.sum(F.when(F.col("signal") == s, F.col("n")).otherwise(0)).alias(s) for s in signals)
        )
        joined = members.select("release_id").distinct().join(lags, "release_id", "left").join(shown, "release_id", "left")
        filled = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n", *signals)}
        return reduce(lambda df, c: df.withColumn(c, filled[c]), filled, joined)
