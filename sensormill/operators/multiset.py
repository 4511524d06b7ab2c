"""Multisets of keys and rows: counts are kept, so [a] and [a, a] differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormill.functions.canonical import fingerprint, row_hash
from sensormill.schemas import SOURCE_KEY


def key_counts(df: DataFrame, keys: Sequence[str] = SOURCE_KEY, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def compare(source: DataFrame, table: DataFrame, keys: Sequence[str] = SOURCE_KEY) -> DataFrame:
    """Every key of either side with its counts and what is missing, extra or duplicated.

    Both sides are tagged, appended and counted in one aggregation: equal keys combine before the only shuffle, and
    NULL keys match, as they do in a grouping. A surplus is a *duplicate* where the source has the key at all and
    *extra* otherwise.
    """
    both = source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        table.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    counted = both.groupBy(*keys).agg(F.sum("_s").alias("source_n"), F.sum("_t").alias("table_n"))
    surplus = F.greatest(F.col("table_n") - F.col("source_n"), F.lit(0))
    return counted.select(
        *keys,
        "source_n",
        "table_n",
        F.greatest(F.col("source_n") - F.col("table_n"), F.lit(0)).alias("missing"),
        F.when(F.col("source_n") == 0, surplus).otherwise(F.lit(0)).alias("extra"),
        F.when(F.col("source_n") > 0, surplus).otherwise(F.lit(0)).alias("duplicate"),
    )


def differences(compared: DataFrame) -> DataFrame:
    return compared.where("missing > 0 OR extra > 0 OR duplicate > 0")


def _status() -> Column:
    return (
        F.when(F.col("source_total") == 0, F.lit("empty_source"))
        .when(F.col("missing") > 0, F.lit("incomplete"))
        .when((F.col("extra") > 0) | (F.col("duplicate") > 0), F.lit("surplus"))
        .otherwise(F.lit("ok"))
    )


def summarise(compared: DataFrame, by: Sequence[str] = ("log_id",)) -> DataFrame:
    """One row per log. Completeness has the source as denominator and is NULL, never 1, for an empty source."""
    sums = compared.groupBy(*by).agg(
        F.sum("source_n").alias("source_total"),
        F.sum("table_n").alias("table_total"),
        F.sum("missing").alias("missing"),
        F.sum("extra").alias("extra"),
        F.sum("duplicate").alias("duplicate"),
    )
    landed = (F.col("source_total") - F.col("missing")).cast("double")
    return sums.withColumn(
        "completeness", F.when(F.col("source_total") > 0, landed / F.col("source_total").cast("double"))
    ).withColumn("status", _status())


def refuse_empty_source(summary: DataFrame) -> DataFrame:
    """Strict form: evaluating the result fails if any log has an empty source."""
    message = F.concat(F.lit("source has no keys: "), F.coalesce(F.col("log_id"), F.lit("?")))
    return summary.withColumn(
        "status",
        F.when(F.col("source_total") == 0, F.raise_error(message).cast("string")).otherwise(F.col("status")),
    )


def row_differences(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose multiplicity differs, by canonical row hash: NaN equals NaN, and -0.0 differs from 0.0."""
    compared = compare(
        left.select(row_hash(left, columns).alias("row_hash")),
        right.select(row_hash(right, columns).alias("row_hash")),
        ["row_hash"],
    )
    return differences(compared).select(
        "row_hash", F.col("source_n").alias("left_n"), F.col("table_n").alias("right_n")
    )


def same_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row telling whether both sides hold the same rows with the same multiplicity.

    Compares two fingerprints, so no row is shuffled. ``row_differences`` shows which rows differ.
    """
    both = fingerprint(left, columns).withColumn("_side", F.lit("left")).unionByName(
        fingerprint(right, columns).withColumn("_side", F.lit("right"))
    )
    return both.agg(
        F.max(F.when(F.col("_side") == "left", F.col("n_rows"))).alias("left_rows"),
        F.max(F.when(F.col("_side") == "right", F.col("n_rows"))).alias("right_rows"),
        (F.min("fingerprint") == F.max("fingerprint")).alias("same"),
    )
