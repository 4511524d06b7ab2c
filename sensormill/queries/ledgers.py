"""Commit ledger queries.

Orders play ledger rows: the customer is the log, the priority the source digest, the status the transform version, and
the order date the ledger position. A customer ordering again with the same priority and status re-activates a commit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.timing import epoch_ns
from sensormill.operators import ledger as ops
from sensormill.operators.integrity import filled_counts, in_scope, log_bounds
from sensormill.queries.registry import query, table

AS_OF_NS = 883_612_800_000_000_000  # 1998-01-01


def _ledger(orders: DataFrame) -> DataFrame:
    return orders.select(
        epoch_ns(orders, "o_orderdate").alias("seq"),
        F.col("o_custkey").cast("string").alias("log_id"),
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("commit_id"),
        F.col("o_orderpriority").alias("source_digest"),
        F.col("o_orderstatus").alias("transform_version"),
    )


_ROWS = """SELECT epoch_ns(o_orderdate) AS seq, CAST(o_custkey AS VARCHAR) AS log_id, 'c' || o_orderkey AS commit_id,
  o_orderpriority AS source_digest, o_orderstatus AS transform_version FROM orders"""
_LEDGER = f"""ledger AS ({_ROWS}),
commits AS (SELECT log_id, source_digest, transform_version, arg_min(commit_id, (seq, commit_id)) AS commit_id,
  min(seq) AS committed_seq FROM ledger GROUP BY ALL),
activations AS (SELECT l.seq, l.log_id, c.commit_id FROM ledger l JOIN commits c ON c.log_id = l.log_id
  AND c.source_digest = l.source_digest AND c.transform_version = l.transform_version),
latest AS (SELECT log_id, arg_max(commit_id, (seq, commit_id)) AS commit_id FROM activations GROUP BY log_id)"""


@query(f"WITH {_LEDGER} SELECT * FROM commits")
def committed_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ops.commits(_ledger(table(spark, folder, "orders")))


@query(f"WITH {_LEDGER} SELECT * FROM latest")
def latest_activation(spark: SparkSession, folder: str) -> DataFrame:
    return ops.latest(ops.activations(_ledger(table(spark, folder, "orders"))))


@query(
    f"""WITH {_LEDGER} SELECT log_id, arg_max(commit_id, (seq, commit_id)) AS commit_id FROM activations
WHERE seq <= {AS_OF_NS} GROUP BY log_id"""
)
def latest_activation_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Time travel: the active commits as they were at a ledger position."""
    return ops.latest(ops.activations(_ledger(table(spark, folder, "orders"))), AS_OF_NS)


def _order_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").cast("string").alias("log_id"),
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("ingest_commit_id"),
        "o_totalprice",
    )


@query(
    f"""WITH {_LEDGER} SELECT l.log_id, l.commit_id AS ingest_commit_id, o.o_totalprice FROM latest l
JOIN orders o ON CAST(o.o_custkey AS VARCHAR) = l.log_id AND 'c' || o.o_orderkey = l.commit_id"""
)
def visible_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return ops.visible(_order_rows(orders), ops.latest(ops.activations(_ledger(orders))))


@query(
    f"""WITH {_LEDGER} SELECT o_custkey, o_orderkey FROM orders
WHERE 'c' || o_orderkey NOT IN (SELECT commit_id FROM commits)"""
)
def uncommitted_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    rows = orders.select("o_custkey", "o_orderkey", F.concat(F.lit("c"), F.col("o_orderkey")).alias("ingest_commit_id"))
    return ops.uncommitted(rows, ops.commits(_ledger(orders))).drop("ingest_commit_id")


_SPLIT = f"""rows AS ({_ROWS}), old AS (SELECT * FROM rows WHERE seq <= {AS_OF_NS}),
candidates AS (SELECT * FROM rows WHERE seq > {AS_OF_NS}),
known AS (SELECT log_id, source_digest, transform_version, arg_min(commit_id, (seq, commit_id)) AS commit_id
  FROM old GROUP BY ALL)"""


def _old_and_new(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = _ledger(table(spark, folder, "orders"))
    return ops.commits(rows.where(F.col("seq") <= AS_OF_NS)), rows.where(F.col("seq") > AS_OF_NS)


@query(
    f"""WITH {_SPLIT} SELECT c.log_id, c.source_digest, c.transform_version, c.commit_id AS candidate_id, k.commit_id
FROM candidates c LEFT JOIN known k ON k.log_id = c.log_id AND k.source_digest = c.source_digest
AND k.transform_version = c.transform_version"""
)
def identity_lookup(spark: SparkSession, folder: str) -> DataFrame:
    known, candidates = _old_and_new(spark, folder)
    asked = candidates.withColumnRenamed("commit_id", "candidate_id").drop("seq")
    return ops.find_commits(asked, known)


@query(
    f"""WITH {_SPLIT} SELECT c.log_id, c.source_digest, c.transform_version, min(c.commit_id) AS commit_id
FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.log_id = c.log_id
AND k.source_digest = c.source_digest AND k.transform_version = c.transform_version) GROUP BY ALL"""
)
def commits_to_insert(spark: SparkSession, folder: str) -> DataFrame:
    known, candidates = _old_and_new(spark, folder)
    return ops.new_commits(candidates, known)


@query(
    f"""WITH {_LEDGER}, first AS (SELECT log_id, arg_min(commit_id, (seq, commit_id)) AS commit_id FROM activations
  GROUP BY log_id)
SELECT f.* FROM first f JOIN latest l ON l.log_id = f.log_id WHERE f.commit_id <> l.commit_id"""
)
def activations_to_append(spark: SparkSession, folder: str) -> DataFrame:
    """Going back to each log's first commit: only logs for which that changes something."""
    activated = ops.activations(_ledger(table(spark, folder, "orders")))
    first = activated.groupBy("log_id").agg(F.min_by("commit_id", F.struct("seq", "commit_id")).alias("commit_id"))
    return ops.changed_activations(first, ops.latest(activated))


@query(
    """WITH l AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), r AS (SELECT DISTINCT o_orderkey AS id FROM orders
  WHERE o_orderstatus <> 'P'),
m AS (SELECT CASE WHEN r.id IS NULL THEN 'left_only' WHEN l.id IS NULL THEN 'right_only' ELSE 'both' END AS membership
  FROM l FULL JOIN r ON l.id = r.id)
SELECT membership, count(*) AS n_commits FROM m GROUP BY membership"""
)
def commit_id_membership(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("ingest_commit_id"))
    orders = table(spark, folder, "orders").where("o_orderstatus <> 'P'")
    return ops.commit_id_sets(lines, orders.select(F.col("o_orderkey").alias("ingest_commit_id")))


GIVEN = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
)


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in GIVEN))
def rows_per_table(spark: SparkSession, folder: str) -> DataFrame:
    counts = [
        table(spark, folder, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in GIVEN
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS log_id, coalesce(min(epoch_ns(o_orderdate)), 0) AS start_ns,
  coalesce(max(epoch_ns(o_orderdate)), 0) AS end_ns
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY c_custkey"""
)
def bounds_per_log(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    stamps = orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").cast("string").alias("log_id"), epoch_ns(orders, "o_orderdate").alias("timestamp_ns")
    )
    logs = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("log_id"))
    return log_bounds(logs, stamps)


@query(
    """SELECT lang, count(*) AS n_rows, count(quality) AS n_quality, count(toxic) AS n_toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY lang"""
)
def filled_counts_per_language(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return filled_counts(joined, ["lang"], ["quality", "toxic"])


@query(
    """SELECT l_suppkey AS log_id, count(*) AS n_rows FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY l_suppkey"""
)
def rows_of_listed_logs(spark: SparkSession, folder: str) -> DataFrame:
    """A log list limits a scan through a semi-join."""
    listed = table(spark, folder, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("log_id"))
    rows = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("log_id"))
    return in_scope(rows, listed).groupBy("log_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """SELECT 'c' || o_orderkey AS commit_id, '{"pose":' || o_orderkey || ',"track":' ||
  CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE CAST(o_custkey AS VARCHAR) END || '}' AS snapshots FROM orders"""
)
def snapshot_map_json(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot ids per table as JSON, with null for a table nothing was appended to."""
    track = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    rows = table(spark, folder, "orders").select(
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("commit_id"),
        F.create_map(F.lit("pose"), F.col("o_orderkey"), F.lit("track"), track).alias("snapshots"),
    )
    return ops.export_commits(rows)
