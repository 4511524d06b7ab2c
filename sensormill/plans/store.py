"""Where canonical tables live: Parquet folders, or tables of the session's catalog (such as Iceberg)."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.schemas import LEDGER_DDL, PARTITION_COLUMNS, TABLE_DDL, conform, table_schema
from sensormill.workspace import read_if_there

#: What could not be taken in, and why: a file, a log or a message.
QUARANTINE_DDL = "log_id STRING, object STRING, reason STRING, detail STRING, commit_id STRING"
#: Appends whose rows were written again elsewhere: their own files no longer count.
MOVES_DDL = "table_name STRING, from_append BIGINT, to_append BIGINT, seq BIGINT"
TAG_DDL = "tag STRING, table_name STRING, snapshot_id BIGINT, tagged_at TIMESTAMP"


def next_snapshot_id() -> int:
    return time.time_ns()


class ParquetStore:
    """Tables as Parquet folders partitioned by ``append_id``.

    An append is one write under a new ``append_id``, so the state after any append is a partition filter. The
    ledger decides which rows readers see; nothing is ever overwritten. Rewritten appends (see ``plans/health``) have ids
    below zero and count only once a row of ``moves`` puts them in place of others.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas or {t: table_schema(t) for t in TABLE_DDL}

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def ensure_tables(self) -> None:
        """Create what does not exist; safe to repeat."""
        for name, schema in {**self.schemas, "ledger": _ddl(LEDGER_DDL), "tags": _ddl(TAG_DDL), "quarantine": _ddl(QUARANTINE_DDL)}.items():
            if read_if_there(self.spark, _with_append_id(schema), self._path(name)) is not None:
                continue
            empty = self.spark.createDataFrame([], _with_append_id(schema))
            empty.write.mode("append").partitionBy("append_id").parquet(self._path(name))

    def append(self, table: str, df: DataFrame, append_id: int) -> int:
        """Append in the table's own schema and return the rows written."""
        rows = conform(df, self.schemas[table])
        clustered = PARTITION_COLUMNS.get(table)
        if clustered:
            # Adaptive execution gathers small logs into one file and splits a large log over several; sorted rows let
            # a filter on the log skip row groups. A folder per log would mean a tiny file per log.
            rows = rows.hint("rebalance", *(F.col(c) for c in clustered)).sortWithinPartitions(*clustered)
        return self._write(table, rows, append_id)

    def _write(self, name: str, df: DataFrame, append_id: int) -> int:
        seen = Observation()
        counted = df.withColumn("append_id", F.lit(append_id)).observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.mode("append").partitionBy("append_id").parquet(self._path(name))
        return seen.get["n"]

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(_with_append_id(schema)).parquet(self._path(name))

    def read(self, table: str, as_of: int | None = None) -> DataFrame:
        """All rows, or the rows the table had at snapshot ``as_of``; committed or not."""
        return self.read_appends(table, as_of).select(*self.schemas[table].fieldNames())

    def read_appends(self, table: str, as_of: int | None = None) -> DataFrame:
        """All rows with the ``append_id`` they lie under, by which the folders are cut."""
        rows = self._read(table, self.schemas[table])
        own = rows.where(F.col("append_id") >= 0)
        if as_of is not None:
            own = own.where(F.col("append_id") <= as_of)
        moves = self.moves(table, as_of)
        if moves is None:
            return own
        left = own.join(moves.select(F.col("from_append").alias("append_id")), "append_id", "left_anti")
        again = rows.where(F.col("append_id") < 0).join(moves.select(F.col("to_append").alias("append_id")).distinct(), "append_id", "left_semi")
        return left.unionByName(again)

    def moves(self, table: str, as_of: int | None = None) -> DataFrame | None:
        """(from_append, to_append) of what was rewritten, as of a snapshot; None if nothing ever was."""
        found = read_if_there(self.spark, _with_append_id(_ddl(MOVES_DDL)), self._path("moves"))
        if found is None:
            return None
        mine = found.where(F.col("table_name") == table)
        return (mine if as_of is None else mine.where(F.col("seq") <= as_of)).select("from_append", "to_append")

    def append_moves(self, rows: DataFrame, seq: int) -> int:
        """One file, one rename: all appends of a rewrite change places together."""
        return self._write("moves", conform(rows, _ddl(MOVES_DDL)).coalesce(1), seq)

    def snapshot_of(self, table: str, append_id: int) -> int:
        """The snapshot that the append ``append_id`` made."""
        return append_id

    def quarantine(self) -> DataFrame:
        return self._read("quarantine", _ddl(QUARANTINE_DDL)).drop("append_id")

    def append_quarantine(self, rows: DataFrame, append_id: int) -> int:
        return self._write("quarantine", conform(rows, _ddl(QUARANTINE_DDL)), append_id)

    def quarantine_appends(self) -> DataFrame:
        """The quarantine with the ``append_id`` each row came with."""
        return self._read("quarantine", _ddl(QUARANTINE_DDL))

    def replace_quarantine(self, rows: DataFrame, append_id: int) -> None:
        """Put ``rows`` in place of whatever the quarantine holds of this append: it may be written again."""
        tagged = conform(rows, _ddl(QUARANTINE_DDL)).withColumn("append_id", F.lit(append_id).cast("bigint"))
        writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("append_id").parquet(self._path("quarantine"))

    def snapshot_ids(self, tables: Iterable[str] | None = None) -> dict[str, int | None]:
        """Latest append per table, None where nothing has been appended. Reads partition values and file footers."""
        return {
            t: self._read(t, self.schemas[t]).agg(F.max("append_id")).first()[0] for t in (tables or self.schemas)
        }

    def ledger(self) -> DataFrame:
        return self._read("ledger", _ddl(LEDGER_DDL)).drop("append_id")

    def append_ledger(self, rows: DataFrame, append_id: int) -> int:
        """One file, one rename: all commits and activations of a batch appear together or not at all."""
        return self._write("ledger", conform(rows, _ddl(LEDGER_DDL)).coalesce(1), append_id)

    def tag(self, name: str, table: str, snapshot_id: int) -> None:
        row = self.spark.range(1).select(
            F.lit(name).alias("tag"),
            F.lit(table).alias("table_name"),
            F.lit(snapshot_id).alias("snapshot_id"),
            F.current_timestamp().alias("tagged_at"),
        )
        self._write("tags", row, next_snapshot_id())

    def tagged(self, name: str, table: str) -> int | None:
        rows = self._read("tags", _ddl(TAG_DDL)).where((F.col("tag") == name) & (F.col("table_name") == table))
        return rows.agg(F.max_by("snapshot_id", "append_id")).first()[0]


class CatalogStore:
    """The same tables in a catalog namespace; ``provider`` is ``iceberg`` where its runtime is on the class path."""

    def __init__(self, spark: SparkSession, namespace: str, provider: str = "iceberg"):
        self.spark = spark
        self.namespace = namespace
        self.provider = provider
        self.schemas = {t: table_schema(t) for t in TABLE_DDL}

    def ensure_tables(self) -> None:
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.namespace}")
        for table, ddl in {**TABLE_DDL, "ledger": LEDGER_DDL, "quarantine": QUARANTINE_DDL}.items():
            parts = PARTITION_COLUMNS.get(table)
            clause = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.namespace}.{table} ({ddl}) USING {self.provider}{clause}")

    def append(self, table: str, df: DataFrame, append_id: int = 0) -> int:
        return self._insert(table, conform(df, table_schema(table)))

    def _insert(self, table: str, rows: DataFrame) -> int:
        """INSERT by name, because a partitioned table lists its partition columns last."""
        name = f"{self.namespace}.{table}"
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        counted.select(*self.spark.table(name).columns).write.insertInto(name)
        return seen.get["n"]

    def read(self, table: str, as_of: int | None = None) -> DataFrame:
        name = f"{self.namespace}.{table}"
        df = self.spark.table(name) if as_of is None else self.spark.sql(f"SELECT * FROM {name} VERSION AS OF {as_of:d}")
        return df.select(*table_schema(table).fieldNames())

    def snapshot_ids(self, tables: Iterable[str] | None = None) -> dict[str, int | None]:
        if self.provider != "iceberg":
            return dict.fromkeys(tables or TABLE_DDL)
        return {
            t: self.spark.sql(
                f"SELECT max_by(snapshot_id, committed_at) FROM {self.namespace}.{t}.snapshots"
            ).first()[0]
            for t in (tables or TABLE_DDL)
        }

    def snapshot_of(self, table: str, append_id: int) -> int | None:
        """The snapshot that the latest append made; NULL where the provider keeps none."""
        return self.snapshot_ids([table])[table]

    def quarantine(self) -> DataFrame:
        return self.spark.table(f"{self.namespace}.quarantine")

    def append_quarantine(self, rows: DataFrame, append_id: int = 0) -> int:
        return self._insert("quarantine", conform(rows, _ddl(QUARANTINE_DDL)))

    def ledger(self) -> DataFrame:
        return self.spark.table(f"{self.namespace}.ledger")

    def append_ledger(self, rows: DataFrame, append_id: int = 0) -> int:
        return self._insert("ledger", conform(rows, _ddl(LEDGER_DDL)).coalesce(1))

    def tag(self, name: str, table: str, snapshot_id: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.namespace}.{table} CREATE TAG `{name}` AS OF VERSION {snapshot_id:d}")

    def tagged(self, name: str, table: str) -> int | None:
        refs = self.spark.table(f"{self.namespace}.{table}.refs").where(F.col("name") == name)
        row = refs.select("snapshot_id").first()
        return row[0] if row else None


def _ddl(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def _with_append_id(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("append_id", T.LongType())])
