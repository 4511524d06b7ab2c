"""Health of a table of small appends: with what a dead ingest left, and before and after a rewrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.plans.health import file_ledger, rewrite_small, table_health
from sensormill.plans.reconcile import active_rows
from sensormill.plans.store import ParquetStore
from sensormill.queries.registry import query, table
from sensormill.workspace import fresh_path, materialise

_ROWS = "log_id STRING, ingest_commit_id STRING, doc_id BIGINT, quality INT, toxic INT"


def _lake(spark: SparkSession, folder: str) -> ParquetStore:
    """Every source is a log with an append and a commit of its own; one more ingest died before its ledger row."""
    store = ParquetStore(spark, fresh_path(spark, "lake"), {"labels": T.StructType.fromDDL(_ROWS)})
    store.ensure_tables()
    labels = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "source"), "doc_id").where("source IS NOT NULL")
    rows = labels.select(F.col("source").alias("log_id"), F.concat("source", F.lit("-1")).alias("ingest_commit_id"), "doc_id", "quality", "toxic")
    numbers = rows.select("log_id").distinct().withColumn("seq", F.abs(F.xxhash64("log_id")) % 1_000_000_007 + 1)
    placed = rows.join(numbers, "log_id").withColumnRenamed("seq", "append_id").repartition("append_id")
    placed.write.mode("append").partitionBy("append_id").parquet(f"{store.root}/labels")
    ledger = numbers.select("seq", "log_id", F.concat("log_id", F.lit("-1")).alias("commit_id"), F.lit("d").alias("source_digest"), F.lit("v1").alias("transform_version"))
    store.append_ledger(ledger, 1)
    store.append("labels", rows.withColumn("ingest_commit_id", F.lit("dead")).coalesce(1), 2_000_000_000)
    return store


@query(
    """WITH l AS (SELECT source, count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT count(*) AS sources, CAST(sum(n) AS BIGINT) AS n_rows FROM l)
SELECT 'before' AS moment, n_rows, sources AS n_snapshots, sources AS n_files, sources AS n_small, 1 AS n_orphans FROM s
UNION ALL SELECT 'after', n_rows, 1, 1, 1, 1 + sources FROM s"""
)
def table_health_before_and_after(spark: SparkSession, folder: str) -> DataFrame:
    """Small appends of all sources become one; what readers see stays, and old and dead files are named as left over."""
    store = _lake(spark, folder)
    found = None
    for moment in ("before", "after"):
        if moment == "after":
            rewrite_small(store, "labels")
        seen = active_rows(store, "labels").count()
        health = table_health(store).select(*(F.col(c).cast("bigint").alias(c) for c in ("n_snapshots", "n_files", "n_small", "n_orphans")))
        one = materialise(health.withColumns({"n_rows": F.lit(seen), "moment": F.lit(moment)}), "health")
        found = one if found is None else found.unionByName(one)
    return found


@query(
    """WITH l AS (SELECT source, count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE source IS NOT NULL GROUP BY source)
SELECT 'live' AS state, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_files FROM l UNION ALL SELECT 'dead_append', CAST(sum(n) AS BIGINT), 1 FROM l"""
)
def dead_ingest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and files by what counts: an ingest that died left rows under a commit without a ledger row, which no reader sees."""
    store = _lake(spark, folder)
    files = file_ledger(store).groupBy("state").agg(F.count(F.lit(1)).alias("n_files"))
    every, seen = store.read("labels").count(), active_rows(store, "labels").count()
    rows = F.when(F.col("state") == "live", F.lit(seen)).otherwise(F.lit(every - seen)).cast("bigint")
    return files.select("state", rows.alias("n_rows"), "n_files")
