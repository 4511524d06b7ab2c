"""The gate mart of a store that goes through three ingests and a re-activation, updated after each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators.gates import evaluate_gates
from sensormill.plans.mart import GateMart, Updated
from sensormill.plans.store import ParquetStore
from sensormill.queries.registry import query, table
from sensormill.workspace import fresh_path

_RESULTS = "log_id STRING, ingest_commit_id STRING, doc_id BIGINT, lang STRING, n_chars BIGINT, quality INT, toxic INT"
DIMENSIONS = ["gate", "log_id", "lang"]


def _outcomes(rows: DataFrame) -> DataFrame:
    rules = {
        "good_quality": F.col("quality") == 1,
        "not_toxic": F.col("toxic") == 0,
        "long_enough": F.col("n_chars") >= 200,
        "licence_known": F.lit(None).cast("boolean"),
    }
    return evaluate_gates(rows, rules, ["log_id", "ingest_commit_id", "lang"])


def _history(spark: SparkSession, folder: str) -> tuple[GateMart, list[Updated]]:
    """The source is the log. First its texts in other languages than German come in, then all texts of logs with an even
    number, then only the English ones of logs whose number ends in 0 or 5; last, those in 0 go back to their second state."""
    documents = table(spark, folder, "documents").where("source IS NOT NULL").join(table(spark, folder, "labels"), "doc_id", "left")
    rows = documents.select(F.col("source").alias("log_id"), "doc_id", "lang", "n_chars", "quality", "toxic")
    store = ParquetStore(spark, fresh_path(spark, "results"), {"results": T.StructType.fromDDL(_RESULTS)})
    store.ensure_tables()
    mart = GateMart(store, fresh_path(spark, "mart"), "results", _outcomes, ["gate", "lang"])
    last = F.substring("log_id", -1, 1)
    even, fives, tens = last.isin(*"02468"), last.isin(*"05"), last == "0"
    updates = []

    def commit(logs: Column, state: int, append_id: int) -> None:
        name = F.concat(F.col("log_id"), F.lit(f"-{state}"))
        found = rows.where(logs).select("log_id").distinct()
        entries = found.select(
            F.lit(append_id).cast("bigint").alias("seq"), "log_id", name.alias("commit_id"),
            F.lit(f"digest-{state}").alias("source_digest"), F.lit("v1").alias("transform_version"),
        )
        store.append_ledger(entries, append_id)
        updates.append(mart.update())

    def ingest(state: int, logs: Column, content: Column) -> None:
        taken = rows.where(logs & content).withColumn("ingest_commit_id", F.concat(F.col("log_id"), F.lit(f"-{state}")))
        store.append("results", taken, 10 * state)
        commit(logs, state, 10 * state)

    ingest(1, F.lit(True), F.coalesce(F.col("lang") != "de", F.lit(True)))
    ingest(2, even, F.lit(True))
    ingest(3, fives, F.coalesce(F.col("lang") == "en", F.lit(False)))
    commit(tens, 2, 40)
    return mart, updates


_LOGS = """d AS (SELECT source AS log_id, doc_id, lang, n_chars, quality, toxic, right(source, 1) AS last
  FROM documents LEFT JOIN labels USING (doc_id) WHERE source IS NOT NULL)"""
_ACTIVE = f"""{_LOGS}, t AS (SELECT * FROM d WHERE CASE WHEN last = '0' THEN TRUE WHEN last = '5' THEN coalesce(lang = 'en', FALSE)
  WHEN last IN ('2', '4', '6', '8') THEN TRUE ELSE coalesce(lang <> 'de', TRUE) END),
o AS (SELECT log_id, lang, 'good_quality' AS gate, quality = 1 AS passed FROM t
  UNION ALL SELECT log_id, lang, 'not_toxic', toxic = 0 FROM t
  UNION ALL SELECT log_id, lang, 'long_enough', n_chars >= 200 FROM t
  UNION ALL SELECT log_id, lang, 'licence_known', NULL FROM t)"""


@query(
    f"""WITH {_ACTIVE} SELECT gate, log_id, lang, CAST(grouping_id(gate, log_id, lang) AS BIGINT) AS level,
  count(passed) AS evaluated, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  count(*) - count(passed) AS skipped FROM o GROUP BY ROLLUP (gate, log_id, lang)"""
)
def quality_mart_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The mart after all four steps equals one computed from the active rows alone."""
    mart, _ = _history(spark, folder)
    return mart.rolled_up(DIMENSIONS)


@query(
    f"""WITH {_LOGS}, l AS (SELECT DISTINCT log_id, last FROM d)
SELECT 1 AS step, (SELECT count(*) FROM l) AS n_logs, (SELECT count(*) FROM l) AS n_read,
  4 * (SELECT count(*) FROM d WHERE coalesce(lang <> 'de', TRUE)) AS n_outcomes
UNION ALL SELECT 2, (SELECT count(*) FROM l WHERE last IN ('0', '2', '4', '6', '8')), (SELECT count(*) FROM l WHERE last IN ('0', '2', '4', '6', '8')),
  4 * (SELECT count(*) FROM d WHERE last IN ('0', '2', '4', '6', '8'))
UNION ALL SELECT 3, (SELECT count(*) FROM l WHERE last IN ('0', '5')), (SELECT count(*) FROM l WHERE last IN ('0', '5')),
  4 * (SELECT count(*) FROM d WHERE last IN ('0', '5') AND lang = 'en')
UNION ALL SELECT 4, (SELECT count(*) FROM l WHERE last = '0'), 0, 0"""
)
def quality_mart_updates(spark: SparkSession, folder: str) -> DataFrame:
    """What each update looked at: only logs with another active commit, and nothing for one that was counted before."""
    _, updates = _history(spark, folder)
    rows = [(step + 1, u.n_logs, u.n_read, u.n_outcomes) for step, u in enumerate(updates)]
    one = [spark.range(1).select(*(F.lit(v).cast("bigint").alias(c) for c, v in zip(("step", "n_logs", "n_read", "n_outcomes"), row, strict=True))) for row in rows]
    return reduce(DataFrame.unionByName, one).withColumn("step", F.col("step").cast("int"))
