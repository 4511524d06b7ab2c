"""A gate mart that is kept up to date by change sets: only logs whose active commit changed are looked at.

Counts can be added and taken away, so the mart is a table of signed partial counts per log, commit and dimensions. When
a log gets another commit, the counts of the old one are entered once more with the opposite sign, from the mart's own
rows, and those of the new one are added. A commit that was counted before is never read again.

An update writes its counts, then which commit each log counts with, then one row saying that the update holds. Readers
and later updates go by that row, so an update that died in between does not count and is simply done again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators import ledger as ledgers
from sensormill.operators.gates import rolled_up
from sensormill.plans.reconcile import commit_rows
from sensormill.plans.store import next_snapshot_id
from sensormill.workspace import materialise, read_if_there

#: What adds up: outcomes, those looked at, and those that passed.
COUNTS = ("n", "evaluated", "passed")
_UPDATE = "update_id"


@dataclass(frozen=True)
class Updated:
    update_id: int | None  # None: nothing had changed
    n_logs: int = 0  # logs whose active commit changed
    n_read: int = 0  # logs whose rows were read
    n_outcomes: int = 0  # outcomes counted from those rows


class GateMart:
    """Counters per log and dimensions over the active commits of a store.

    ``outcomes`` turns rows of ``table`` into rows (log_id, ingest_commit_id, dimensions, passed).
    """

    def __init__(self, store, path: str, table: str, outcomes: Callable[[DataFrame], DataFrame], dimensions: Sequence[str]):
        self.store, self.path, self.table, self.outcomes, self.dimensions = store, path.rstrip("/"), table, outcomes, list(dimensions)
        self.spark = store.spark

    def update(self) -> Updated:
        """Bring the mart to the commits that are active now."""
        active = ledgers.latest(ledgers.activations(self.store.ledger()))
        counted = self._counted()
        current = counted.groupBy("log_id").agg(F.max_by(F.struct("commit_id"), _UPDATE).alias("_c")).select("log_id", F.col("_c.commit_id").alias("_old"))
        both = active.join(current, "log_id", "full").where(~F.col("commit_id").eqNullSafe(F.col("_old")))
        # The first update a commit was counted with has its counts.
        first = counted.where("commit_id IS NOT NULL").groupBy("log_id", "commit_id").agg(F.min(_UPDATE).alias("_first"))
        changes = materialise(both.join(first, ["log_id", "commit_id"], "left"), "mart-changes")
        n_logs = changes.count()
        if not n_logs:
            return Updated(None)
        unseen = changes.where("commit_id IS NOT NULL AND _first IS NULL").select("log_id", "commit_id")
        added = materialise(self._count(commit_rows(self.store, self.table, unseen)), "mart-counts")
        returning = changes.where("_first IS NOT NULL").select("log_id", "commit_id", "_first")
        gone = changes.where("_old IS NOT NULL").select("log_id", F.col("_old").alias("commit_id")).join(first, ["log_id", "commit_id"])
        facts = added.unionByName(self._again(returning, 1)).unionByName(self._again(gone, -1))
        update_id = next_snapshot_id()
        self._write("facts", facts, update_id)
        self._write("counted", changes.select("log_id", "commit_id"), update_id)
        self._write("updates", self.spark.range(1).select(F.current_timestamp().alias("updated_at")), update_id)
        outcomes = added.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return Updated(update_id, n_logs, unseen.count(), outcomes)

    def per_log(self) -> DataFrame:
        """log_id, dimensions and counters of every log with outcomes."""
        sums = self._facts().groupBy("log_id", *self.dimensions).agg(*(F.sum(F.col("sign") * F.col(c)).alias(c) for c in COUNTS))
        return sums.where("n > 0")

    def rolled_up(self, dimensions: Sequence[str] | None = None) -> DataFrame:
        """Counters for every prefix of ``dimensions``, down to the total."""
        return rolled_up(self.per_log(), dimensions or self.dimensions)

    def _count(self, rows: DataFrame) -> DataFrame:
        passed = F.col("passed")
        return self.outcomes(rows).groupBy("log_id", F.col("ingest_commit_id").alias("commit_id"), *self.dimensions).agg(
            F.lit(1).alias("sign"), F.count(F.lit(1)).alias("n"), F.count(passed).alias("evaluated"),
            F.sum(F.coalesce(passed, F.lit(False)).cast("bigint")).alias("passed"),
        )

    def _again(self, commits: DataFrame, sign: int) -> DataFrame:
        """The counts of commits (log_id, commit_id, _first), as they were first entered, with ``sign``."""
        facts = self._facts().where("sign = 1")
        wanted = commits.select("log_id", "commit_id", F.col("_first").alias(_UPDATE))
        found = facts.join(wanted, ["log_id", "commit_id", _UPDATE], "left_semi")
        return found.drop(_UPDATE).withColumn("sign", F.lit(sign))

    def _schema(self, name: str) -> T.StructType:
        if name == "updates":
            return T.StructType.fromDDL(f"updated_at TIMESTAMP, {_UPDATE} BIGINT")
        if name == "counted":
            return T.StructType.fromDDL(f"log_id STRING, commit_id STRING, {_UPDATE} BIGINT")
        kinds = {f.name: f for f in self.outcomes(self.store.read(self.table)).schema}
        counts = T.StructType.fromDDL(f"sign INT, {', '.join(f'{c} BIGINT' for c in COUNTS)}, {_UPDATE} BIGINT")
        own = [T.StructField("log_id", T.StringType()), T.StructField("commit_id", T.StringType()), *(kinds[d] for d in self.dimensions)]
        return T.StructType([*own, *counts])

    def _write(self, name: str, rows: DataFrame, update_id: int) -> None:
        rows.withColumn(_UPDATE, F.lit(update_id)).write.mode("append").partitionBy(_UPDATE).parquet(f"{self.path}/{name}")

    def _read(self, name: str) -> DataFrame:
        schema = self._schema(name)
        rows = read_if_there(self.spark, schema, f"{self.path}/{name}")
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def _holding(self, name: str) -> DataFrame:
        """Rows of updates that were finished."""
        return self._read(name).join(self._read("updates").select(_UPDATE), _UPDATE, "left_semi")

    def _facts(self) -> DataFrame:
        return self._holding("facts")

    def _counted(self) -> DataFrame:
        return self._holding("counted")
