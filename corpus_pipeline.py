"""A training corpus from raw documents: select by quality, join near copies, decontaminate, redact secrets, mix.

Each stage takes (spark, docs, sf_dir) and returns a table that is written before the next one reads it. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensormill.llm import decontaminate, jaccard, mixing, quality, secret_ledger
from sensormill.llm.tables import table
from sensormill.shipping import ship
from sensormill.workspace import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the top grade is high enough; poor and toxic ones go."""
    ship(spark)
    return quality.select(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every class linked at 0.8 over five-word shingles."""
    ship(spark)
    return jaccard.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark phrases are cut out of the texts."""
    ship(spark)
    return decontaminate.cut_spans(docs, table(spark, sf_dir, "benchmark"), width=10)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    ship(spark)
    return secret_ledger.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document that is left."""
    return mixing.mixed(docs).select("doc_id", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: The classifier is fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{number}")
    return docs
