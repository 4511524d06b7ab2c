"""File listings with size and SHA-256."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.paths import relative_to, strip_scheme
from sensormill.sources.paths import locate
from sensormill.workspace import spread

CHUNK = 1 << 20
_LISTED = "log_id string, root string, path string, byte_size bigint, is_folder boolean"


def log_list(spark: SparkSession, path: str) -> DataFrame:
    """Log ids from a text file, one per line; blank lines do not count."""
    lines = spark.read.text(path).select(F.trim("value").alias("log_id"))
    return lines.where(F.col("log_id") != "").distinct()


def log_folders(log_ids: DataFrame, data_root: str) -> DataFrame:
    """(log_id, root): each id joined to the folder that holds the log folders."""
    return log_ids.select("log_id", F.concat(F.lit(data_root.rstrip("/") + "/"), F.col("log_id")).alias("root"))


def _expand(recursive: bool):
    """Replace folder rows by what they hold; file rows pass through."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            files = batch[~batch["is_folder"]]
            if not files.empty:
                yield files
            for row in batch[batch["is_folder"]].itertuples(index=False):
                system, base, named = locate(row.path)
                found = system.get_file_info(fs.FileSelector(base, recursive=recursive, allow_not_found=True))
                listed = [i for i in found if i.type == fs.FileType.File or not recursive]
                if listed:
                    yield pd.DataFrame(
                        {
                            "log_id": row.log_id,
                            "root": row.root,
                            "path": [named(i.path) for i in listed],
                            "byte_size": [i.size if i.type == fs.FileType.File else None for i in listed],
                            "is_folder": [i.type == fs.FileType.Directory for i in listed],
                        }
                    ).astype({"byte_size": "Int64"})

    return expand


def list_files(folders: DataFrame, levels: int = 3) -> DataFrame:
    """Every file below each (log_id, root), including hidden ones: log_id, root, path, byte_size.

    ``binaryFile`` skips names that start with ``_`` or ``.``, but a source digest must not. The first ``levels``
    levels are listed folder by folder with a shuffle between, so one large log is listed by many tasks.
    """
    rows = folders.select(
        "log_id",
        "root",
        F.col("root").alias("path"),
        F.lit(None).cast("bigint").alias("byte_size"),
        F.lit(True).alias("is_folder"),
    )
    for level in range(levels + 1):
        rows = spread(rows, "path").mapInPandas(_expand(recursive=level == levels), _LISTED)
    return rows.where("NOT is_folder").drop("is_folder")


def _hash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums = []
        for path in batch["path"]:
            running = hashlib.sha256()
            system, name, _ = locate(path)
            with system.open_input_stream(name) as stream:
                while chunk := stream.read(CHUNK):
                    running.update(chunk)
            sums.append(running.hexdigest())
        yield batch.assign(checksum=sums)


def hash_files(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """Add ``checksum``. Files of any size are streamed in chunks; ``binaryFile`` would load each into one row.

    Paths are spread by hash over all tasks, whichever log they belong to, because cameras of one log dominate.
    """
    return spread(files, "path", partitions).mapInPandas(_hash_batches, f"{_ddl(files)}, checksum string")


def tasks_for(files: DataFrame, bytes_per_task: int = 512 << 20) -> int:
    """How many tasks the payload bytes of a listing are worth."""
    total = files.agg(F.sum("byte_size")).first()[0] or 0
    return -(-total // bytes_per_task)


def _probe_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        sizes, sums = [], []
        for path in batch["source_path"]:
            system, name, _ = locate(path)
            info = system.get_file_info(name)
            if info.type != fs.FileType.File:
                sizes.append(None)
                sums.append(None)
                continue
            running = hashlib.sha256()
            with system.open_input_stream(name) as stream:
                while chunk := stream.read(CHUNK):
                    running.update(chunk)
            sizes.append(info.size)
            sums.append(running.hexdigest())
        found = pd.DataFrame({"source_path": batch["source_path"], "byte_size": sizes, "checksum": sums})
        yield found.astype({"byte_size": "Int64"})[found["checksum"].notna()]


def probe_files(paths: DataFrame) -> DataFrame:
    """(source_path, byte_size, checksum) of the given paths as they are now; a path without a file has no row."""
    schema = "source_path string, byte_size bigint, checksum string"
    return spread(paths.select("source_path"), "source_path").mapInPandas(_probe_batches, schema)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def payload_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Visible files below ``root`` with size and SHA-256 computed in the JVM; for payloads below 2 GiB each."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(
            strip_scheme(F.col("path")).alias("source_path"),
            F.col("length").alias("byte_size"),
            F.sha2(F.col("content"), 256).alias("checksum"),
        )
    )


def payload_listing(spark: SparkSession, root: str) -> DataFrame:
    """Paths and sizes only; the content column is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(strip_scheme(F.col("path")).alias("source_path"), F.col("length").alias("byte_size"))
    )


def digest_items(hashed: DataFrame) -> DataFrame:
    """(log_id, item) with item ``relative/path|sha256``: moving the log folder changes nothing."""
    return hashed.select(
        "log_id", F.concat(relative_to(F.col("path"), F.col("root")), F.lit("|"), F.col("checksum")).alias("item")
    )
