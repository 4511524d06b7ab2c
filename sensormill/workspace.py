"""Where intermediate tables go: the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def workspace(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session without one gets a folder of this machine instead."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """A folder for this process, gone when it ends."""
    folder = tempfile.mkdtemp(prefix="sensormill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def read_if_there(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame | None:
    """The Parquet rows at ``path``, None if there is no such path. Any other trouble is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


#: Paths handed out by this process, in order.
_handed_out: list[str] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside the block are removed when it ends, also when it fails.

    What the block computes must be written or collected inside it: a result that is read later would miss its tables.
    Without such a block the tables stay in the shared folder. One block at a time and per process.
    """
    before = len(_handed_out)
    try:
        yield
    finally:
        for path in _handed_out[before:]:
            _remove(spark, path)
        del _handed_out[before:]


def _remove(spark: SparkSession, path: str) -> None:
    """Through Hadoop's file systems, as Spark wrote it; a path that was never written is no trouble."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders a task may write to at the same time; each holds a row group of ``ROW_GROUP`` bytes.
OPEN_FILES, ROW_GROUP = 16, 16 << 20
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_unsorted(df: DataFrame, path: str, folders: Sequence[str]) -> None:
    """Write a folder per value of ``folders`` without sorting: rows go to their file as they come.

    Spark sorts rows by their folders, to have one file open at a time, and a task that holds a large folder sorts all of
    it. With some files open at once a task holds their row groups only; beyond ``OPEN_FILES`` folders Spark sorts the rest.
    """
    spark = df.sparkSession
    before = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, str(OPEN_FILES))
    try:
        df.write.option("parquet.block.size", str(ROW_GROUP)).partitionBy(*folders).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, before)


def spread(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Hash rows that stand for outside work, such as paths to read, over all task slots.

    The number is explicit on purpose: adaptive execution would otherwise merge partitions by the size of the path
    strings and give one task the payloads of a hundred thousand files. A hash of the column is what is dealt by: where
    the rows come from a grouping by the column itself, Spark takes that shuffle for this one, and merges it.
    """
    spark = df.sparkSession
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(max(partitions or 0, slots), F.xxhash64(column))
