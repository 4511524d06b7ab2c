"""Referential and sensor checks, gates, quarantine and the numbers reported about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.paths import folder_name, is_log_id, is_numbered_file, relative_to, stamp_ns
from sensormill.functions.timing import epoch_ns
from sensormill.operators import gates, integrity, sweeps
from sensormill.operators.ordered import quantiles
from sensormill.queries.registry import EVENT_FRAMES_SQL, event_frames, query, table
from sensormill.queries.timelines import DAY_NS, _rank_sql


@query(
    """WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS log_id, o_orderpriority AS sensor_name,
    arg_max(o_totalprice, o_orderkey) AS qw FROM orders GROUP BY ALL),
i AS (SELECT CAST(o_custkey AS VARCHAR) AS log_id, o_orderpriority AS sensor_name,
    arg_max(o_totalprice, o_orderkey) AS fx_px FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT e.log_id, e.sensor_name, e.qw, i.fx_px FROM e
LEFT JOIN i ON i.log_id = e.log_id AND i.sensor_name = e.sensor_name"""
)
def calibration_join(spark: SparkSession, folder: str) -> DataFrame:
    """Extrinsics with or without intrinsics; the last of repeated rows counts."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("log_id"),
        F.col("o_orderpriority").alias("sensor_name"),
        F.col("o_orderkey").alias("row_index"),
        "o_totalprice",
        "o_orderstatus",
    )
    extrinsics = orders.select("log_id", "sensor_name", "row_index", F.col("o_totalprice").alias("qw"))
    intrinsics = orders.where("o_orderstatus = 'F'").select(
        "log_id", "sensor_name", "row_index", F.col("o_totalprice").alias("fx_px")
    )
    return integrity.calibrations(extrinsics, intrinsics)


@query(
    """WITH k AS (SELECT 'part/' || p_partkey AS calibration_id, CASE WHEN p_size > 25 THEN 'F' ELSE 'O' END AS ingest_commit_id
  FROM part WHERE p_type <> 'ECONOMY')
SELECT l_linestatus AS ingest_commit_id, l_orderkey, l_linenumber, 'part/' || l_partkey AS calibration_id
FROM lineitem WHERE l_returnflag <> 'N' AND ('part/' || l_partkey, l_linestatus) NOT IN (SELECT calibration_id, ingest_commit_id FROM k)"""
)
def dangling_references(spark: SparkSession, folder: str) -> DataFrame:
    """A reference counts only within its commit: parts have one of the two, so the commit decides as well as the id."""
    name = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("part/"), F.col("l_partkey")))
    rows = table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("ingest_commit_id"), "l_orderkey", "l_linenumber", name.alias("calibration_id")
    )
    known = table(spark, folder, "part").where("p_type <> 'ECONOMY'").select(
        F.concat(F.lit("part/"), F.col("p_partkey")).alias("calibration_id"),
        F.when(F.col("p_size") > 25, "F").otherwise("O").alias("ingest_commit_id"),
    )
    return integrity.dangling_calibrations(rows, known)


@query(
    f"""WITH {EVENT_FRAMES_SQL}, present AS (
  SELECT DISTINCT log_id || '-' || (timestamp_ns // {DAY_NS}) AS log_id, sensor FROM frames),
expected(sensor) AS (VALUES ('click'), ('error'), ('purchase'), ('ring_rear_left'), ('signup'), ('view'))
SELECT l.log_id, e.sensor FROM (SELECT DISTINCT log_id FROM present) l CROSS JOIN expected e
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.log_id = l.log_id AND p.sensor = e.sensor)"""
)
def expected_sensor_gaps(spark: SparkSession, folder: str) -> DataFrame:
    day = F.floor(F.col("timestamp_ns") / DAY_NS).cast("string")
    present = event_frames(spark, folder).select(F.concat_ws("-", "log_id", day).alias("log_id"), "sensor")
    expected = ("click", "error", "purchase", "ring_rear_left", "signup", "view")
    return integrity.missing_sensors(present.select("log_id").distinct(), present, expected)


@query(
    """SELECT value, regexp_matches(value, '^[A-Za-z0-9][A-Za-z0-9_-]*$') AS valid FROM (
  SELECT c_name AS value FROM customer UNION SELECT source FROM documents UNION SELECT url FROM pages
  UNION SELECT source || chr(10) FROM documents UNION SELECT o_orderpriority FROM orders)"""
)
def log_id_check(spark: SparkSession, folder: str) -> DataFrame:
    sources = table(spark, folder, "documents").select("source")
    values = (
        table(spark, folder, "customer").select(F.col("c_name").alias("value"))
        .union(sources)
        .union(table(spark, folder, "pages").select("url"))
        .union(sources.select(F.concat("source", F.lit("\n"))))
        .union(table(spark, folder, "orders").select("o_orderpriority"))
    )
    return values.distinct().select("value", is_log_id(F.col("value")).alias("valid"))


_STEM = r"(^|/)[0-9]+(\.[^./]+)?$"


@query(
    rf"""WITH u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path FROM pages)
SELECT page_id, regexp_matches(path, '{_STEM}') AS numbered,
  CASE WHEN regexp_matches(path, '{_STEM}') THEN TRY_CAST(regexp_extract(path, '(^|/)([0-9]+)(\.[^./]+)?$', 2) AS BIGINT)
  END AS timestamp_ns, list_extract(string_split(path, '/'), -2) AS folder, substr(path, 9) AS inside FROM u"""
)
def path_parts(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("path"))
    path = F.col("path")
    return pages.select(
        "page_id",
        is_numbered_file(path).alias("numbered"),
        stamp_ns(path).alias("timestamp_ns"),
        folder_name(path).alias("folder"),
        relative_to(path, F.lit("http://")).alias("inside"),
    )


@query(
    """SELECT label, CAST(floor(m / 0.5) AS BIGINT) AS bucket, count(*) AS n_points FROM (
  SELECT label, sqrt(x * x + y * y + z * z) * 10 AS m FROM (
    SELECT label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z
    FROM embeddings)) GROUP BY ALL"""
)
def range_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The first three components of a vector are a point; its label is the sweep."""
    x, y, z = (F.get("embedding", F.lit(i)).cast("double") for i in range(3))
    points = table(spark, folder, "embeddings").select("label", (sweeps.point_range(x, y, z) * 10).alias("range_m"))
    return sweeps.range_distribution(points, ["label"], bucket_m=0.5)


@query(_rank_sql("orders", "o_orderpriority", "o_totalprice", (1, 50, 95)))
def value_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact percentiles of a double over large groups."""
    return quantiles(table(spark, folder, "orders"), ["o_orderpriority"], "o_totalprice", (1, 50, 95))


RASTER_SQL = """raster AS (SELECT CAST(p_size AS BIGINT) AS cell_x, CAST(substr(p_brand, 7) AS BIGINT) AS cell_y,
  (floor(CAST(sum(CAST(p_retailprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*)) - 1000) / 64.0 AS height_m
  FROM part GROUP BY ALL)"""


def raster(spark: SparkSession, folder: str) -> DataFrame:
    """Heights per cell from the parts."""
    price = F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double")
    cells = table(spark, folder, "part").groupBy(
        F.col("p_size").cast("bigint").alias("cell_x"), F.expr("CAST(substring(p_brand, 7) AS BIGINT)").alias("cell_y")
    )
    return cells.agg(((F.floor(price / F.count(F.lit(1))) - 1000) / F.lit(64.0)).alias("height_m"))


@query(
    f"""WITH {EVENT_FRAMES_SQL}, {RASTER_SQL},
p AS (SELECT log_id, CAST(floor(value) AS BIGINT) AS cell_x, CAST(floor(k / 4) AS BIGINT) AS cell_y, CAST(k AS DOUBLE) / 64 AS wz
  FROM frames)
SELECT p.log_id, count(*) AS n_points, count(height_m) AS n_on_raster, avg(wz - height_m) AS mean_m,
  sqrt(avg((wz - height_m) * (wz - height_m))) AS rms_m, max(abs(wz - height_m)) AS max_abs_m
FROM p LEFT JOIN raster r ON r.cell_x = p.cell_x AND r.cell_y = p.cell_y GROUP BY p.log_id"""
)
def ground_residual(spark: SparkSession, folder: str) -> DataFrame:
    """Heights are multiples of 1/64, so that sums are exact in any order."""
    points = event_frames(spark, folder).select(
        "log_id",
        F.col("value").alias("wx"),
        F.floor(F.col("k") / 4).cast("double").alias("wy"),
        (F.col("k") / F.lit(64.0)).alias("wz"),
    )
    return sweeps.ground_residuals(points, raster(spark, folder), ["log_id"], cell_m=1.0, region=[])


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    targets = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )
    rules = {
        "good_quality": F.col("quality") == 1,
        "not_toxic": F.col("toxic") == 0,
        "long_enough": F.col("n_chars") >= 200,
        "licence_known": F.lit(None).cast("boolean"),
    }
    return gates.evaluate_gates(targets, rules, ["source", "lang", "doc_id"])


_OUTCOMES = """t AS (SELECT d.doc_id, source, lang, n_chars, quality, toxic FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id),
o AS (SELECT doc_id, source, lang, 'good_quality' AS gate, quality = 1 AS passed FROM t
  UNION ALL SELECT doc_id, source, lang, 'not_toxic', toxic = 0 FROM t
  UNION ALL SELECT doc_id, source, lang, 'long_enough', n_chars >= 200 FROM t
  UNION ALL SELECT doc_id, source, lang, 'licence_known', NULL FROM t)"""
_COUNTERS = """CAST(sum(CASE WHEN passed IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS evaluated,
  CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  CAST(sum(CASE WHEN NOT passed THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN passed IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS skipped"""


@query(f"WITH {_OUTCOMES} SELECT gate, source, {_COUNTERS} FROM o GROUP BY gate, source")
def gate_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return gates.gate_counters(_outcomes(spark, folder), ["gate", "source"])


@query(
    f"""WITH {_OUTCOMES} SELECT gate FROM (SELECT gate, {_COUNTERS} FROM o GROUP BY gate)
WHERE skipped > 0 OR evaluated = 0"""
)
def gates_to_alert_on(spark: SparkSession, folder: str) -> DataFrame:
    return gates.silent_gates(gates.gate_counters(_outcomes(spark, folder))).select("gate")


@query(
    f"""WITH {_OUTCOMES} SELECT gate, source, lang, CAST(grouping_id(gate, source, lang) AS BIGINT) AS level, {_COUNTERS}
FROM o GROUP BY ROLLUP (gate, source, lang)"""
)
def quality_mart(spark: SparkSession, folder: str) -> DataFrame:
    return gates.gate_mart(_outcomes(spark, folder), ["gate", "source", "lang"])


def _rules() -> dict:
    return {
        "too_short": F.col("n_chars") < 100,
        "not_english": F.col("lang") != "en",
        "has_address": F.col("text").contains("@"),
        "low_quality": F.col("quality") == 0,
    }


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


_REASONS = """m AS (SELECT d.doc_id, source, concat_ws(',',
    CASE WHEN n_chars < 100 THEN 'too_short' END, CASE WHEN lang <> 'en' THEN 'not_english' END,
    CASE WHEN contains(text, '@') THEN 'has_address' END, CASE WHEN quality = 0 THEN 'low_quality' END) AS reasons
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


@query(f"WITH {_REASONS} SELECT doc_id, reasons FROM m WHERE reasons <> ''")
def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = gates.split_quarantine(_documents(spark, folder), _rules())
    return bad.select("doc_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_REASONS} SELECT doc_id, source FROM m WHERE reasons = ''")
def rows_without_reason(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = gates.split_quarantine(_documents(spark, folder), _rules())
    return good.select("doc_id", "source")


@query(
    f"""WITH {_REASONS} SELECT source, reason, count(*) AS n_rows FROM (
  SELECT source, unnest(string_split(reasons, ',')) AS reason FROM m WHERE reasons <> '') GROUP BY ALL"""
)
def quarantine_depth(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = gates.split_quarantine(_documents(spark, folder), _rules())
    return gates.quarantine_depth(bad, ["source"])


_LAGS = """lags AS (SELECT o_orderpriority, epoch_ns(l_shipdate) - epoch_ns(o_orderdate) AS lag_ns
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


@query(f"WITH {_LAGS} {_rank_sql('lags', 'o_orderpriority', 'lag_ns', (50, 95))}")
def freshness_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """From order to shipment, as from emission to being queryable."""
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    emitted = orders.select("o_orderkey", "o_orderpriority", epoch_ns(orders, "o_orderdate").alias("emitted_ns"))
    landed = lines.select(F.col("l_orderkey").alias("o_orderkey"), epoch_ns(lines, "l_shipdate").alias("queryable_ns"))
    return gates.freshness(landed.join(emitted, "o_orderkey"), ["o_orderpriority"], "emitted_ns", "queryable_ns")


@query(
    """WITH f AS (SELECT doc_id, 'toxic' AS fault_type FROM labels WHERE toxic = 1
  UNION ALL SELECT doc_id, 'low_quality' FROM labels WHERE quality = 0),
d AS (SELECT doc_id FROM documents WHERE n_chars < 400 OR contains(text, '@') OR contains(text, 'http'))
SELECT fault_type, count(*) AS n_faults, count(d.doc_id) AS n_detected,
  CAST(count(d.doc_id) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS recall
FROM f LEFT JOIN d ON d.doc_id = f.doc_id GROUP BY fault_type"""
)
def fault_recall(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    faults = labels.where("toxic = 1").select("doc_id", F.lit("toxic").alias("fault_type")).union(
        labels.where("quality = 0").select("doc_id", F.lit("low_quality"))
    )
    text = F.col("text")
    found = table(spark, folder, "documents").where(
        (F.col("n_chars") < 400) | text.contains("@") | text.contains("http")
    )
    return gates.fault_recall(faults, found, ["doc_id"])
