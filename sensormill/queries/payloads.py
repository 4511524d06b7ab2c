"""File sources over payload files that Spark tasks write from the documents: source is the log, language the camera."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.canonical import digest_by
from sensormill.operators.multiset import key_counts
from sensormill.operators.normalise import frames
from sensormill.queries.registry import query, table
from sensormill.sources.files import digest_items, hash_files, list_files, log_folders, payload_listing
from sensormill.sources.keys import source_keys
from sensormill.sources.paths import locate
from sensormill.workspace import fresh_path


def _write_files(rows: Iterable[Row]) -> None:
    for row in rows:
        system, path, _ = locate(row.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(path) as stream:
            stream.write(row.text.encode())


def _tree(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """(root, log folders). Writing is repeatable: a task that runs again writes the same files."""
    root = fresh_path(spark, "payloads")
    documents = table(spark, folder, "documents")
    path = F.concat_ws(
        "/", F.lit(root), "source", F.lit("sensors/cameras"), "lang", F.concat(F.col("doc_id"), F.lit(".jpg"))
    )
    documents.select(path.alias("path"), "text").foreachPartition(_write_files)
    return root, log_folders(documents.select(F.col("source").alias("log_id")).distinct(), root)


@query("SELECT source AS log_id, lang AS sensor, doc_id AS timestamp_ns, count(*) AS n FROM documents GROUP BY ALL")
def payload_source_keys(spark: SparkSession, folder: str) -> DataFrame:
    _, folders = _tree(spark, folder)
    return key_counts(source_keys(folders))


@query(
    """SELECT source AS log_id, lang AS sensor, doc_id AS timestamp_ns, CAST(strlen(text) AS BIGINT) AS byte_size,
  sha256(text) AS checksum, 'jpeg' AS codec FROM documents"""
)
def payload_frames(spark: SparkSession, folder: str) -> DataFrame:
    _, folders = _tree(spark, folder)
    found = frames(hash_files(list_files(folders)))
    return found.select("log_id", "sensor", "timestamp_ns", "byte_size", "checksum", "codec")


_ITEM = "'sensors/cameras/' || lang || '/' || doc_id || '.jpg|' || sha256(text)"


@query(
    f"""SELECT log_id, sha256(string_agg(strlen(item) || ':' || item, '' ORDER BY item)) AS source_digest
FROM (SELECT source AS log_id, {_ITEM} AS item FROM documents) GROUP BY log_id"""
)
def payload_source_digests(spark: SparkSession, folder: str) -> DataFrame:
    _, folders = _tree(spark, folder)
    return digest_by(digest_items(hash_files(list_files(folders))), ["log_id"], "item", "source_digest")


@query("SELECT count(*) AS n_files, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM documents")
def payload_listing_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes from the file index alone; no payload is opened."""
    root, _ = _tree(spark, folder)
    return payload_listing(spark, root).agg(F.count(F.lit(1)).alias("n_files"), F.sum("byte_size").alias("n_bytes"))
