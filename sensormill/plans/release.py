"""Releases over a store: pinned once as a whole, then loaded identically or refused by name."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators import ledger as ledgers
from sensormill.operators import tree
from sensormill.operators.releases import changed_blobs, changed_tables, pin_blobs, pin_tables, scoped
from sensormill.schemas import SOURCE_KEY
from sensormill.sources.files import probe_files
from sensormill.workspace import materialise, read_if_there

HEADER = "attempt_id STRING, policy_version STRING, transform_version STRING, created_at TIMESTAMP"
PARTS = {
    "commits": "log_id STRING, commit_id STRING",
    "tables": "table_name STRING, snapshot_id BIGINT, n_rows BIGINT, fingerprint STRING",
    "blobs": "source_path STRING, byte_size BIGINT, checksum STRING",
    "nodes": "table_name STRING, path STRING, n_rows BIGINT, fingerprint STRING",
    "rows": "table_name STRING, shelf STRING, leaf STRING, key STRING, row_hash STRING, copies BIGINT",
}
#: By which columns a row of a table is named; all its columns where a table is not listed.
ROW_KEYS = {
    "log": ("log_id",),
    "sensor_data": SOURCE_KEY,
    "pose": ("log_id", "timestamp_ns"),
    "calibration": ("log_id", "sensor"),
    "track": ("log_id", "timestamp_ns", "track_uuid"),
}
#: Objects in the message of a refusal; the stored table has all of them.
NAMED = 20


class ReleaseRefused(RuntimeError):
    """The release is not what was pinned; the message names the objects."""


class Releases:
    """Release pins next to the tables of a store.

    Parts are written under the id of the attempt, and the header, written last, says which attempt is the release. An
    attempt that dies leaves parts that nobody reads, and the next one starts anew. Of two attempts that both end, the
    earlier header counts.
    """

    def __init__(self, store, root: str):
        self.store = store
        self.spark = store.spark
        self.root = root.rstrip("/")

    def _write(self, part: str, rows: DataFrame, key: str, value: str) -> None:
        tagged = rows.withColumn(key, F.lit(value))
        shelves = [c for c in ("table_name", "shelf") if part == "rows"]
        tagged.write.mode("append").partitionBy(key, *shelves).parquet(f"{self.root}/{part}")

    def _attempt(self, release_id: str) -> str | None:
        """The attempt that became the release."""
        schema = T.StructType.fromDDL(HEADER + ", release_id STRING")
        headers = read_if_there(self.spark, schema, f"{self.root}/headers")
        if headers is None:
            return None
        mine = headers.where(F.col("release_id") == release_id)
        return mine.agg(F.min_by("attempt_id", F.struct("created_at", "attempt_id"))).first()[0]

    def _attempt_part(self, part: str, attempt: str | None) -> DataFrame:
        schema = T.StructType.fromDDL(PARTS[part] + ", attempt_id STRING")
        rows = read_if_there(self.spark, schema, f"{self.root}/{part}")
        if rows is None:
            rows = self.spark.createDataFrame([], schema)
        return rows.where(F.col("attempt_id") == F.lit(attempt)).drop("attempt_id")

    def part(self, part: str, release_id: str) -> DataFrame:
        return self._attempt_part(part, self._attempt(release_id))

    def exists(self, release_id: str) -> bool:
        return self._attempt(release_id) is not None

    def _tables(self, commits: DataFrame) -> dict[str, DataFrame]:
        return {t: ledgers.visible(self.store.read(t), commits) for t in self.store.schemas}

    def create(self, release_id: str, logs: DataFrame, policy_version: str, transform_version: str) -> None:
        """Pin the active commits of ``logs``: row contents of every table, hash of every blob, both versions."""
        if self.exists(release_id):
            raise ValueError(f"release {release_id} exists; releases never change")
        attempt = uuid.uuid4().hex
        active = ledgers.latest(ledgers.activations(self.store.ledger()))
        self._write("commits", active.join(logs.select("log_id"), "log_id", "left_semi"), "attempt_id", attempt)
        commits = self._attempt_part("commits", attempt)
        tables = self._tables(commits)
        snapshots = ledgers.recorded_snapshots(self.store.ledger())
        pins = pin_tables(tables).join(snapshots, "table_name", "left")
        self._write("tables", pins.select("table_name", "snapshot_id", "n_rows", "fingerprint"), "attempt_id", attempt)
        self._write("blobs", pin_blobs(tables["sensor_data"]), "attempt_id", attempt)
        sizes = {r.table_name: r.n_rows for r in self._attempt_part("tables", attempt).select("table_name", "n_rows").collect()}
        for name, rows in tables.items():
            depth = tree.depth_for(sizes[name])
            marked = materialise(self._marks(name, rows, depth), "release-marks")
            self._write("nodes", tree.nodes(marked, depth).withColumn("table_name", F.lit(name)), "attempt_id", attempt)
            shelved = marked.withColumns({"table_name": F.lit(name), "shelf": F.substring(F.concat("leaf", F.lit("-")), 1, 1)})
            self._write("rows", shelved.repartitionByRange("leaf").sortWithinPartitions("leaf"), "attempt_id", attempt)
        header = self.spark.range(1).select(
            F.lit(attempt).alias("attempt_id"),
            F.lit(policy_version).alias("policy_version"),
            F.lit(transform_version).alias("transform_version"),
            F.current_timestamp().alias("created_at"),
        )
        self._write("headers", header, "release_id", release_id)

    @staticmethod
    def _marks(name: str, rows: DataFrame, depth: int) -> DataFrame:
        columns = scoped(rows)
        return tree.marks(rows, ROW_KEYS.get(name, columns), depth, columns)

    def changed_rows(self, release_id: str, name: str) -> tuple[DataFrame, list[tuple[int, int]]]:
        """(key, problem, n_pinned, n_now) of the rows of a table that are not as pinned, and the nodes compared by level.

        The table is read once for its tree. The pinned rows are read only on the shelves of leaves that differ.
        """
        pinned = self.part("nodes", release_id).where(F.col("table_name") == name).select("path", "fingerprint")
        depth = pinned.agg(F.coalesce(F.max(F.length("path")), F.lit(0))).first()[0]
        rows = self._tables(self.part("commits", release_id))[name]
        current = materialise(self._marks(name, rows, depth), "current-marks")
        leaves, looked = tree.unequal_leaves(pinned, tree.nodes(current, depth), depth)
        shelf = F.substring(F.concat("leaf", F.lit("-")), 1, 1)
        shelves = [r[0] for r in leaves.select(shelf).distinct().collect()]  # hexadecimal digits, or the one of a lone leaf
        then = self.part("rows", release_id).where((F.col("table_name") == name) & F.col("shelf").isin(shelves))
        return tree.differing_keys(then, current, leaves), looked

    def problems(self, release_id: str, check_blobs: bool = True) -> DataFrame:
        """(object, problem) for everything that differs from the pin: tables, their rows, and blobs."""
        tables = self._tables(self.part("commits", release_id))
        changed = materialise(changed_tables(self.part("tables", release_id), pin_tables(tables)).select("table_name"), "changed-tables")
        found = [changed.select(F.concat(F.lit("table "), "table_name").alias("object"), F.lit("rows_differ").alias("problem"))]
        for name in sorted(r.table_name for r in changed.collect()):  # at most the tables of the store
            rows, _ = self.changed_rows(release_id, name)
            found.append(rows.select(F.concat(F.lit(f"row {name} "), "key").alias("object"), "problem"))
        if check_blobs:
            pinned = self.part("blobs", release_id)
            bad = changed_blobs(pinned, probe_files(pinned))
            found.append(bad.select(F.concat(F.lit("blob "), "source_path").alias("object"), F.col("outcome").alias("problem")))
        return reduce(DataFrame.unionByName, found)

    def load(self, release_id: str, check_blobs: bool = True) -> dict[str, DataFrame]:
        """The pinned rows of every table, or ``ReleaseRefused`` with the path of the table of all that changed."""
        if not self.exists(release_id):
            raise ReleaseRefused(f"release {release_id} was never published")
        path = f"{self.root}/refusals/{uuid.uuid4().hex}"
        self.problems(release_id, check_blobs).write.parquet(path)
        found = self.spark.read.schema("object STRING, problem STRING").parquet(path)
        count = found.count()
        if count:
            some = found.orderBy(F.col("object").startswith("row "), "object").take(NAMED)
            raise ReleaseRefused(f"{count} objects differ, see {path}: " + "; ".join(f"{r.object}: {r.problem}" for r in some))
        return self._tables(self.part("commits", release_id))

    def compare(self, one: str, other: str) -> DataFrame:
        """Tables whose pinned contents differ between two releases."""
        return changed_tables(self.part("tables", one), self.part("tables", other))
