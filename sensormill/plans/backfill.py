"""Partial recomputation: only the units a slice asks for and nothing has done yet, each replacing its own partition."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormill.operators.releases import backfill_work
from sensormill.workspace import materialise, read_if_there


def overwrite_partitions(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace exactly the partitions ``rows`` has; a repeated run changes nothing."""
    (
        rows.hint("rebalance", *(F.col(p) for p in partitions))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def backfill(
    units: DataFrame,
    slice_: Column,
    ids: Sequence[str],
    compute: Callable[[DataFrame], DataFrame],
    out: str,
    done_path: str,
    partitions: Sequence[str] | None = None,
) -> DataFrame:
    """Compute the open units of the slice, write them, then mark them done; returns the units of this run.

    The mark comes last. A run that dies in between leaves results which the next run replaces.
    """
    spark = units.sparkSession
    schema = units.select(*ids).schema
    done = read_if_there(spark, schema, done_path)
    if done is None:
        done = spark.createDataFrame([], schema)
    work = materialise(backfill_work(units, slice_, done, ids), "backfill")
    overwrite_partitions(compute(work), out, partitions or ids)
    work.write.mode("append").parquet(done_path)
    return work
