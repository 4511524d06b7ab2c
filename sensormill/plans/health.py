"""Health of a store's tables: which files count, which are left over, and small appends rewritten into large ones.

A listing by tasks meets what the ledger knows: a file belongs to the append in whose folder it lies, and an append counts
if a commit came with it. What does not count is named with its reason, so it can be removed; nothing here removes files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.operators.ordered import with_running_sum
from sensormill.plans.store import ParquetStore, next_snapshot_id
from sensormill.schemas import PARTITION_COLUMNS
from sensormill.sources.files import list_files
from sensormill.workspace import materialise

SMALL, TARGET = 64 << 20, 512 << 20
_APPEND = r"/append_id=(-?[0-9]+)/[^/]+\.parquet\z"
#: Files that only say how a write went.
_NOTES = r"/(_SUCCESS|_metadata|_common_metadata|\.[^/]*\.crc)\z"


def file_ledger(store: ParquetStore) -> DataFrame:
    """(table_name, path, append_id, byte_size, state) of every file below the store's data tables.

    ``live`` files hold what readers may see. The others are left over: ``dead_append`` of an ingest that never
    committed, ``dead_rewrite`` of a rewrite that died, ``moved`` where a rewrite took over, ``stray`` for anything else.
    """
    spark = store.spark
    found = None
    for name in store.schemas:
        one = spark.range(1).select(F.lit(name).alias("log_id"), F.lit(f"{store.root}/{name}").alias("root"))
        found = one if found is None else found.unionByName(one)
    listed = list_files(found, levels=1).where(~F.col("path").rlike(_NOTES))
    files = listed.select(
        F.col("log_id").alias("table_name"), "path", F.regexp_extract("path", _APPEND, 1).try_cast("bigint").alias("append_id"), "byte_size"
    )
    committed = store.ledger().select(F.col("seq").alias("append_id"), F.lit(True).alias("_committed")).distinct()
    files = files.join(committed, "append_id", "left")
    moved = None
    for name in store.schemas:
        moves = store.moves(name)
        if moves is not None:
            tagged = moves.withColumn("table_name", F.lit(name))
            moved = tagged if moved is None else moved.unionByName(tagged)
    away, here = F.lit(False), F.lit(False)
    if moved is not None:
        files = files.join(moved.select("table_name", F.col("from_append").alias("append_id"), F.lit(True).alias("_away")), ["table_name", "append_id"], "left")
        files = files.join(moved.select("table_name", F.col("to_append").alias("append_id"), F.lit(True).alias("_here")).distinct(), ["table_name", "append_id"], "left")
        away, here = F.col("_away").isNotNull(), F.col("_here").isNotNull()
    stray = F.col("append_id").isNull() | F.col("path").contains("/_temporary/")
    state = (
        F.when(stray, "stray").when(F.col("append_id") < 0, F.when(here, "live").otherwise("dead_rewrite"))
        .when(away, "moved").when(F.col("_committed").isNotNull(), "live").otherwise("dead_append")
    )
    return files.select("table_name", "path", "append_id", "byte_size", state.alias("state"))


def table_health(store: ParquetStore, small: int = SMALL) -> DataFrame:
    """Per table: snapshots that count, live files and bytes, small ones among them, and what is left over."""

    def number(condition, name: str):
        return F.sum(F.when(condition, 1).otherwise(0)).alias(name)

    live = F.col("state") == "live"
    return file_ledger(store).groupBy("table_name").agg(
        F.count_distinct(F.when(live, F.col("append_id"))).alias("n_snapshots"),
        number(live, "n_files"),
        number(live & (F.col("byte_size") < small), "n_small"),
        F.sum(F.when(live, F.col("byte_size")).otherwise(0)).alias("n_bytes"),
        number(~live, "n_orphans"),
        F.sum(F.when(live, 0).otherwise(F.col("byte_size"))).alias("orphan_bytes"),
    )


def rewrite_small(store: ParquetStore, table: str, small: int = SMALL, target: int = TARGET) -> int:
    """Write small neighbouring appends of a table again, about ``target`` bytes together; returns how many moved.

    Appends are packed in their order: bin by running bytes. The new files lie under ids below zero, which nobody reads
    until one row per append, all in one file, says that they count. So a reader sees the old files or the new ones, and a
    rewrite that died is a leftover. The old files stay for readers that have begun, and for time travel.
    """
    appends = file_ledger(store).where((F.col("table_name") == table) & (F.col("state") == "live") & (F.col("append_id") >= 0))
    sizes = appends.groupBy("append_id").agg(F.sum("byte_size").alias("_bytes"), F.min("byte_size").alias("_least"))
    slim = materialise(sizes.where((F.col("_least") < small) & (F.col("_bytes") < target)).withColumn("_all", F.lit(0)), "small-appends")
    packed = with_running_sum(slim, ["_all"], ["append_id"], "_bytes").withColumn("_bin", F.floor((F.col("running") - 1) / target))
    several = packed.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    seq = next_snapshot_id()
    moves = packed.join(several, "_bin").select(
        F.lit(table).alias("table_name"), F.col("append_id").alias("from_append"), (-(F.lit(seq) + F.col("_bin"))).alias("to_append"), F.lit(seq).alias("seq")
    )
    moves = materialise(moves, "moves")
    count = moves.count()
    if count:
        rows = store.read_appends(table).join(moves.select(F.col("from_append").alias("append_id"), "to_append"), "append_id")
        again = rows.drop("append_id").withColumnRenamed("to_append", "append_id").repartition("append_id")
        clustered = again.sortWithinPartitions("append_id", *PARTITION_COLUMNS.get(table, ()))
        clustered.write.mode("append").partitionBy("append_id").parquet(f"{store.root}/{table}")
        store.append_moves(moves, seq)
    return count
