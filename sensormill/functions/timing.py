"""Times are BIGINT nanoseconds since 1970 in UTC; Spark's timestamps would lose the last three digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_ns(df: DataFrame, name: str) -> Column:
    """Nanoseconds of a timestamp column. A zoneless column is read as UTC whatever the session's zone is."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        seconds = (
            F.unix_date(value.cast("date")).cast("bigint") * 86400 + F.hour(value) * 3600 + F.minute(value) * 60
        )
        micros = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
        return (seconds * 1_000_000 + micros) * 1000
    return F.unix_micros(value) * 1000


def ns_to_ms(ns: Column) -> Column:
    return ns.cast("double") / F.lit(1e6)
