"""Payload files: they stay outside the tables, so their existence, size and content are checked here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def manifest(references: DataFrame, prefix: str = "blobs") -> DataFrame:
    """One row per distinct content with its content-addressed key, size and number of references."""
    sha = F.col("checksum")
    return references.groupBy("checksum").agg(
        F.concat_ws("/", F.lit(prefix), F.substring(sha, 1, 2), sha).alias("blob_key"),
        F.min("byte_size").alias("byte_size"),
        F.count(F.lit(1)).alias("n_references"),
    )


def verify(references: DataFrame, listing: DataFrame, path: str = "source_path") -> DataFrame:
    """Each referenced path with ``ok``, ``missing``, ``size_differs`` or ``checksum_differs``."""
    found = listing.select(
        F.col(path), F.col("byte_size").alias("found_size"), F.col("checksum").alias("found_checksum")
    )
    outcome = (
        F.when(F.col("found_size").isNull(), "missing")
        .when(F.col("found_size") != F.col("byte_size"), "size_differs")
        .when(~F.col("found_checksum").eqNullSafe(F.col("checksum")), "checksum_differs")
        .otherwise("ok")
    )
    return references.join(found, path, "left").withColumn("outcome", outcome)


def orphans(listing: DataFrame, references: DataFrame, path: str = "source_path") -> DataFrame:
    """Files no row refers to."""
    return listing.join(references.select(path), path, "left_anti")


def byte_accounts(df: DataFrame, size: str, classes: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Bytes and rows per class, each class on its own: a referenced byte is not a processed byte."""
    sums = [
        F.struct(
            F.lit(name).alias("account"),
            F.count(F.when(condition, 1)).alias("n_rows"),
            F.coalesce(F.sum(F.when(condition, F.col(size))), F.lit(0)).cast("bigint").alias("n_bytes"),
        )
        for name, condition in classes.items()
    ]
    return df.groupBy(*by).agg(F.array(*sums).alias("_a")).select(*by, F.inline("_a"))


def file_health(df: DataFrame, small_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """Files behind a table and how many are small, from file metadata only (no data column is read)."""
    files = df.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).groupBy("file_path").agg(F.max("file_size").alias("file_size"), F.count(F.lit(1)).alias("n_rows"))
    return files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum(F.when(F.col("file_size") < small_bytes, 1).otherwise(0)).alias("n_small_files"),
        F.sum("file_size").alias("n_bytes"),
        F.sum("n_rows").alias("n_rows"),
    )
