"""Service levels of the data as series: counts and sketches that add up over windows, slices and releases.

A sketch counts values by logarithmic buckets, each wider than the one before by a fixed ratio. Two sketches merge by
adding counts, so what is stored per slice and window gives the percentiles of any union of them. A percentile is off by
at most the ``accuracy``, as a share of the value at that rank, however large the numbers are; its rank is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 0.01
#: Bucket of zero; positive values lie above it in order, negative ones below.
ZERO_BUCKET = 0
_FIRST = 1_000_000


def ratio(accuracy: float = ACCURACY) -> float:
    return (1 + accuracy) / (1 - accuracy)


def bucket_of(value: Column, accuracy: float = ACCURACY) -> Column:
    """Number of the bucket; it grows with the value. NULL and NaN have none."""
    place = F.ceil(F.ln(F.abs(value).cast("double")) / F.lit(math.log(ratio(accuracy)))) + _FIRST
    signed = F.when(value > 0, place).when(value < 0, -place).when(value == 0, F.lit(ZERO_BUCKET))
    return F.when(~F.isnan(value.cast("double")), signed.cast("int"))


def bucket_value(bucket: Column, accuracy: float = ACCURACY) -> Column:
    """The value whose distance to all values of the bucket is at most the accuracy."""
    size = F.pow(F.lit(ratio(accuracy)), F.abs(bucket) - _FIRST) * F.lit(2 / (1 + ratio(accuracy)))
    return F.when(bucket == ZERO_BUCKET, F.lit(0.0)).otherwise(F.signum(bucket.cast("double")) * size)


def sketch(df: DataFrame, by: Sequence[str], value: str, accuracy: float = ACCURACY) -> DataFrame:
    """(by, bucket, n): as many rows per group as its values have buckets, whatever their number."""
    placed = df.select(*by, bucket_of(F.col(value), accuracy).alias("bucket")).where("bucket IS NOT NULL")
    return placed.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, by: Sequence[str], percents: Sequence[int] = (50, 95), accuracy: float = ACCURACY) -> DataFrame:
    """(by, n, p<percent>...) by nearest rank, from sketches of any parts of the groups."""
    whole = merged(sketches, by)
    group = Window.partitionBy(*by)  # the buckets of a group: some thousands at most
    ranked = whole.withColumns({"_to": F.sum("n").over(group.orderBy("bucket")), "_all": F.sum("n").over(group)})

    def at(percent: int) -> Column:
        rank = F.greatest(F.lit(1), F.floor((F.col("_all") * percent + 99) / 100))
        hit = (F.col("_to") - F.col("n") < rank) & (rank <= F.col("_to"))
        return F.max(F.when(hit, bucket_value(F.col("bucket"), accuracy))).alias(f"p{percent}")

    return ranked.groupBy(*by).agg(F.sum("n").alias("n"), *(at(p) for p in percents))


def window_of(time_ns: Column, width_ns: int) -> Column:
    return (F.floor(time_ns / F.lit(width_ns)) * width_ns).cast("bigint")


def counted(df: DataFrame, by: Sequence[str], signals: dict[str, Column]) -> DataFrame:
    """(by, signal, n): how many rows show each signal; NULL does not. Sums of these are sums over any parts."""
    marks = F.array_compact(F.array(*(F.when(F.coalesce(shown, F.lit(False)), F.lit(name)) for name, shown in signals.items())))
    return df.select(*by, F.explode(marks).alias("signal")).groupBy(*by, "signal").agg(F.count(F.lit(1)).alias("n"))


def per_release(parts: DataFrame, members: DataFrame, slice_: Sequence[str], release: str = "release_id") -> DataFrame:
    """Stored parts once for every release that has their slice."""
    return parts.join(members.select(release, *slice_).distinct(), list(slice_))
