"""Feather (Arrow IPC file) tables as a Spark source, read batch by batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sensormill.sources.paths import locate
from sensormill.workspace import spread


def _open(path: str):
    system, name, _ = locate(path)
    return pa.ipc.open_file(system.open_input_file(name))


def _conform(batch: pa.RecordBatch, schema: pa.Schema, constants: dict) -> pa.RecordBatch:
    """Pick and cast the wanted columns; a column the file lacks is NULL, ``constants`` come from the caller."""
    columns = []
    for field in schema:
        if field.name in constants:
            columns.append(constants[field.name](batch.num_rows))
        else:
            at = batch.schema.get_field_index(field.name)
            columns.append(
                pa.nulls(batch.num_rows, field.type) if at < 0 else batch.column(at).cast(field.type)
            )
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _read(path: str, schema: pa.Schema, constants: dict) -> Iterator[pa.RecordBatch]:
    reader = _open(path)
    start = 0
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        first = start
        extra = {
            "row_index": lambda n, first=first: pa.array(range(first, first + n), pa.int64()),
            "source_path": lambda n: pa.array([path] * n, pa.string()),
        }
        wanted = {k: v for k, v in {**extra, **constants}.items() if k in schema.names}
        yield _conform(batch, schema, wanted)
        start += batch.num_rows


def read_tables(paths: DataFrame, schema: T.StructType, keys: Sequence[str] = ("log_id",)) -> DataFrame:
    """Rows of many Feather files: ``keys`` of the path row, ``row_index`` in recorded order, then ``schema``.

    ``paths`` is a DataFrame, so a list of a million files is itself distributed and small files share tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    out = T.StructType(
        [*(paths.schema[k] for k in keys), T.StructField("row_index", T.LongType()), *schema.fields]
    )

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out)
        for batch in batches:
            for row in batch.to_pylist():
                constants = {k: (lambda n, v=row[k], t=arrow.field(k).type: pa.array([v] * n, t)) for k in keys}
                yield from _read(row["path"], arrow, constants)

    return spread(paths.select(*keys, "path"), "path").mapInArrow(load, out)


def scan(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of every Feather file below ``root``, with ``row_index``. Folders are listed by tasks, level by level, so no
    list of files passes through the driver; the data source below lists in one process, which suits single tables."""
    from sensormill.sources.files import list_files

    folder = spark.range(1).select(F.lit("").alias("log_id"), F.lit(root).alias("root"))
    return read_tables(list_files(folder).where(F.col("path").endswith(".feather")), schema, keys=())


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _FeatherReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.target = int(options.get("partitionbytes", 128 << 20))

    def partitions(self) -> list[InputPartition]:
        """Files in path order, packed up to the target size per task."""
        from pyarrow import fs

        system, base, named = locate(self.path)
        info = system.get_file_info(base)
        if info.type == fs.FileType.File:
            return [_Files([self.path])]
        found = system.get_file_info(fs.FileSelector(base, recursive=True))
        files = sorted((i.path, i.size) for i in found if i.type == fs.FileType.File and i.path.endswith(".feather"))
        packed: list[InputPartition] = []
        pending: list[str] = []
        size = 0
        for name, length in files:
            if pending and size + length > self.target:
                packed.append(_Files(pending))
                pending, size = [], 0
            pending.append(named(name))
            size += length
        if pending:
            packed.append(_Files(pending))
        return packed or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.schema)
        for path in partition.paths:
            yield from _read(path, arrow, {})


class FeatherSource(DataSource):
    """``spark.read.format("feather").schema(...).load(path)``; ``row_index`` and ``source_path`` may be asked for."""

    @classmethod
    def name(cls) -> str:
        return "feather"

    def schema(self):
        raise ValueError("the feather source needs an explicit schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FeatherReader(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeatherSource)
