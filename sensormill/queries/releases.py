"""Blobs, releases, slices and backfill. Documents play payload files: their text is the content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.timing import epoch_ns
from sensormill.operators import blobs, releases, tree
from sensormill.queries.encodings import _LANES, _float, _int, _row, _text
from sensormill.queries.registry import EVENT_FRAMES_SQL, event_frames, query, table
from sensormill.queries.timelines import DAY_NS
from sensormill.workspace import fresh_path, materialise, write_unsorted


def _references(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.concat(F.lit("docs/"), F.col("doc_id")).alias("source_path"),
        F.octet_length("text").cast("bigint").alias("byte_size"),
        F.sha2("text", 256).alias("checksum"),
    )


_REFERENCES = """refs AS (SELECT 'docs/' || doc_id AS source_path, CAST(strlen(text) AS BIGINT) AS byte_size,
  sha256(text) AS checksum FROM documents)"""


@query(
    f"""WITH {_REFERENCES} SELECT checksum, 'blobs/' || substr(checksum, 1, 2) || '/' || checksum AS blob_key,
min(byte_size) AS byte_size, count(*) AS n_references FROM refs GROUP BY checksum"""
)
def blob_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return blobs.manifest(_references(spark, folder))


@query(
    f"""WITH {_REFERENCES}, found AS (SELECT 'docs/' || doc_id AS source_path,
    CAST(strlen(t) AS BIGINT) AS found_size, sha256(t) AS found_checksum FROM (
  SELECT doc_id, CASE lang WHEN 'fr' THEN text || ' ' WHEN 'es' THEN replace(text, 'e', 'a') ELSE text END AS t
  FROM documents WHERE lang <> 'de'))
SELECT r.source_path, CASE WHEN found_size IS NULL THEN 'missing' WHEN found_size <> byte_size THEN 'size_differs'
  WHEN found_checksum <> checksum THEN 'checksum_differs' ELSE 'ok' END AS outcome
FROM refs r LEFT JOIN found f ON f.source_path = r.source_path"""
)
def blob_verification(spark: SparkSession, folder: str) -> DataFrame:
    """Against a listing in which German files are gone, French ones longer and Spanish ones altered in place."""
    text = (
        F.when(F.col("lang") == "fr", F.concat("text", F.lit(" ")))
        .when(F.col("lang") == "es", F.replace("text", F.lit("e"), F.lit("a")))
        .otherwise(F.col("text"))
    )
    listing = (
        table(spark, folder, "documents")
        .where("lang <> 'de'")
        .select("doc_id", text.alias("text"))
        .select(
            F.concat(F.lit("docs/"), F.col("doc_id")).alias("source_path"),
            F.octet_length("text").cast("bigint").alias("byte_size"),
            F.sha2("text", 256).alias("checksum"),
        )
    )
    return blobs.verify(_references(spark, folder), listing).select("source_path", "outcome")


@query(
    f"""WITH {_REFERENCES} SELECT source_path FROM refs
WHERE source_path NOT IN (SELECT 'docs/' || doc_id FROM labels)"""
)
def blob_orphans(spark: SparkSession, folder: str) -> DataFrame:
    labelled = table(spark, folder, "labels").select(F.concat(F.lit("docs/"), F.col("doc_id")).alias("source_path"))
    return blobs.orphans(_references(spark, folder).select("source_path"), labelled)


@query(
    """WITH b AS (SELECT source, lang, CAST(strlen(text) AS BIGINT) AS n FROM documents)
SELECT source, 'referenced' AS account, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_bytes FROM b GROUP BY source
UNION ALL SELECT source, 'hashed', count(*) FILTER (lang <> 'en'),
  CAST(coalesce(sum(n) FILTER (lang <> 'en'), 0) AS BIGINT) FROM b GROUP BY source
UNION ALL SELECT source, 'written', count(*) FILTER (lang = 'es'),
  CAST(coalesce(sum(n) FILTER (lang = 'es'), 0) AS BIGINT) FROM b GROUP BY source"""
)
def byte_accounts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(
        "source", "lang", F.octet_length("text").cast("bigint").alias("byte_size")
    )
    classes = {
        "referenced": F.lit(True),
        "hashed": F.col("lang") != "en",
        "written": F.col("lang") == "es",
    }
    return blobs.byte_accounts(rows, "byte_size", classes, ["source"])


@query(
    """SELECT CAST(count(DISTINCT (l_returnflag, l_linestatus)) AS BIGINT) AS n_files, count(*) AS n_rows FROM lineitem"""
)
def table_file_health(spark: SparkSession, folder: str) -> DataFrame:
    """Files and rows of a table laid out with one file per flag and status."""
    path, parts = fresh_path(spark, "laid-out"), ["l_returnflag", "l_linestatus"]
    rows = table(spark, folder, "lineitem")
    write_unsorted(rows.repartition(*parts), path, parts)
    return blobs.file_health(spark.read.parquet(path)).select("n_files", "n_rows")


PINNED = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "region": ("r_regionkey", "r_name"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
}
_TEXTS = {"n_name", "r_name", "p_name", "p_brand", "p_type", "c_name", "c_mktsegment"}
_DOUBLES = {"p_retailprice", "c_acctbal"}


def _pin_sql(name: str, rows: str | None = None) -> str:
    encoded = _row(**{c: (_text(c) if c in _TEXTS else _float(c) if c in _DOUBLES else _int(c)) for c in PINNED[name]})
    return f"""SELECT '{name}' AS table_name, n_rows,
  sha256(concat_ws('|', CAST(n_rows AS VARCHAR), l0, l1, l2, l3)) AS fingerprint
FROM (SELECT count(*) AS n_rows, {_LANES} FROM (SELECT sha256({encoded}) AS h FROM {rows or name}))"""


def _pins(spark: SparkSession, folder: str) -> DataFrame:
    return releases.pin_tables({t: table(spark, folder, t) for t in PINNED}, PINNED)


@query(" UNION ALL ".join(_pin_sql(t) for t in PINNED))
def release_pin(spark: SparkSession, folder: str) -> DataFrame:
    return _pins(spark, folder)


@query(
    f"""WITH a AS ({_pin_sql("customer")} UNION ALL {_pin_sql("part")}),
b AS ({_pin_sql("customer", "(SELECT * FROM customer WHERE c_acctbal >= 0)")} UNION ALL {_pin_sql("part")})
SELECT a.table_name, a.n_rows, b.n_rows AS rows_now FROM a JOIN b ON b.table_name = a.table_name
WHERE a.fingerprint <> b.fingerprint"""
)
def release_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A pin against tables of which one has lost rows since."""
    tables = {t: table(spark, folder, t) for t in ("customer", "part")}
    later = {**tables, "customer": tables["customer"].where("c_acctbal >= 0")}
    changed = releases.changed_tables(releases.pin_tables(tables, PINNED), releases.pin_tables(later, PINNED))
    return changed.select("table_name", "n_rows", "rows_now")


@query(
    """SELECT o_custkey AS release_id, max(o_orderkey) AS version, arg_max(o_orderstatus, o_orderkey) AS state
FROM orders GROUP BY o_custkey"""
)
def newest_release_states(spark: SparkSession, folder: str) -> DataFrame:
    return releases.newest_states(_release_events(spark, folder))


def _release_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("release_id"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("state")
    )


@query(
    """WITH h AS (SELECT o_custkey, max(o_orderkey) AS held FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT o.o_custkey AS release_id, o_orderkey AS version, o_orderstatus AS state
FROM orders o JOIN h ON h.o_custkey = o.o_custkey WHERE o_orderkey <= held"""
)
def stale_release_events(spark: SparkSession, folder: str) -> DataFrame:
    events = _release_events(spark, folder)
    held = releases.newest_states(events.where("state = 'F'"))
    return releases.stale_events(events, held)


@query(
    f"""WITH {EVENT_FRAMES_SQL}, s AS (SELECT log_id, timestamp_ns // {DAY_NS} AS day, count(*) AS n_rows,
  CAST(max(CASE WHEN sensor = 'click' THEN 1 ELSE 0 END) + max(CASE WHEN sensor = 'view' THEN 1 ELSE 0 END)
  + max(CASE WHEN sensor = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_required FROM frames GROUP BY ALL)
SELECT * FROM s WHERE n_required >= 2"""
)
def consistent_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Days of a log on which at most one of three required sensors is absent."""
    rows = event_frames(spark, folder).withColumn("day", F.floor(F.col("timestamp_ns") / DAY_NS))
    found = releases.consistent_samples(rows, ["log_id", "day"], ["click", "view", "error"], allow_missing=1)
    return found.withColumn("n_required", F.col("n_required").cast("bigint"))


_SLICE_SENSORS = ("click", "view", "error", "purchase")


@query(
    f"""WITH {EVENT_FRAMES_SQL}, bits(sensor, bit) AS (VALUES ('click', 1), ('view', 2), ('error', 4), ('purchase', 8)),
wanted AS (SELECT event_type AS sensor, 'v' || (CAST(json_extract_string(min(props), '$.k') AS BIGINT) % 2 + 1) AS v FROM events WHERE event_type <> 'error' GROUP BY event_type),
r AS (SELECT log_id, timestamp_ns // {7 * DAY_NS} AS week, bit, w.v IS NOT NULL AND w.v <> CASE WHEN k < 20 THEN 'v1' ELSE w.v END AS wrong,
  o.o_orderkey IS NULL AS gone FROM frames f JOIN bits USING (sensor) LEFT JOIN wanted w USING (sensor)
  LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice > 60000) o ON o.o_orderkey = f.event_id),
s AS (SELECT log_id, week, count(*) AS n_rows, bit_or(bit)::BIGINT AS present, bit_or(CASE WHEN wrong THEN bit ELSE 0 END)::BIGINT AS miscalibrated,
  bit_or(CASE WHEN gone THEN bit ELSE 0 END)::BIGINT AS without_blob FROM r GROUP BY ALL)
SELECT *, CAST(bit_count(present & ~(miscalibrated | without_blob)) AS INTEGER) AS n_usable,
  bit_count(present & ~(miscalibrated | without_blob)) >= 2 AND (present & ~(miscalibrated | without_blob) & 1) = 1 AS usable FROM s"""
)
def usable_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks of a log by all four conditions at once: of four sensors two may be missing, but never the clicks; each has a
    version of its calibration, errors need none; and an order of the event's id is its payload."""
    frames = event_frames(spark, folder).withColumn("week", F.floor(F.col("timestamp_ns") / (7 * DAY_NS)))
    first = F.get_json_object(F.min("props"), "$.k").cast("bigint")
    wanted = table(spark, folder, "events").where("event_type <> 'error'").groupBy(F.col("event_type").alias("sensor")).agg(
        F.concat(F.lit("v"), first % 2 + 1).alias("calibration_id")
    )
    carried = frames.join(wanted.withColumnRenamed("calibration_id", "_v"), "sensor", "left")
    version = F.when(F.col("k") < 20, "v1").otherwise(F.col("_v"))
    rows = carried.select("log_id", "week", "sensor", version.alias("calibration_id"), F.concat(F.lit("e/"), "event_id").alias("source_path"))
    blobs_ = table(spark, folder, "orders").where("o_orderstatus <> 'P' OR o_totalprice > 60000").select(F.concat(F.lit("e/"), "o_orderkey").alias("source_path"))
    return releases.usable_samples(rows, ["log_id", "week"], _SLICE_SENSORS, ["click"], wanted, blobs_, allow_missing=2)


@query(
    """SELECT l_orderkey FROM (SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY ALL)
GROUP BY l_orderkey HAVING max(n) = 1"""
)
def one_calibration_per_sensor(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("sensor"), F.col("l_suppkey").alias("calibration_id")
    )
    return releases.consistent_calibration(rows, ["l_orderkey"])


@query(
    """SELECT DISTINCT l_suppkey, l_returnflag, CAST(year(l_shipdate) AS BIGINT) AS year FROM lineitem l
WHERE l_discount >= 0.05 AND NOT EXISTS (SELECT 1 FROM lineitem d WHERE d.l_linestatus = 'F' AND d.l_tax > 0.07
  AND d.l_suppkey = l.l_suppkey AND d.l_returnflag = l.l_returnflag AND year(d.l_shipdate) = year(l.l_shipdate))"""
)
def backfill_work(spark: SparkSession, folder: str) -> DataFrame:
    ids = ["l_suppkey", "l_returnflag", "year"]
    units = table(spark, folder, "lineitem").withColumn("year", F.year("l_shipdate").cast("bigint"))
    done = units.where("l_linestatus = 'F' AND l_tax > 0.07")
    return releases.backfill_work(units, F.col("l_discount") >= 0.05, done, ids)


@query(
    """SELECT o_custkey, o_orderpriority, count(*) AS n_orders FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY ALL"""
)
def slice_predicate_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A scan limited by a time predicate, which reaches the Parquet reader."""
    orders = table(spark, folder, "orders").where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))


@query(
    """WITH o AS (SELECT *, o_orderkey % 500 AS m FROM orders WHERE o_orderkey % 500 IN (7, 11, 13, 17))
SELECT '{"o_orderkey":' || CASE m WHEN 17 THEN -o_orderkey ELSE o_orderkey END || '}' AS key,
  CASE m WHEN 7 THEN 'changed' WHEN 11 THEN 'lost' WHEN 13 THEN 'doubled' ELSE 'added' END AS problem,
  CASE m WHEN 17 THEN 0 ELSE 1 END::BIGINT AS n_pinned, CASE m WHEN 11 THEN 0 WHEN 13 THEN 2 ELSE 1 END::BIGINT AS n_now FROM o"""
)
def release_changed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows in which orders differ from their pin, found by descending two trees of fingerprints."""
    orders = table(spark, folder, "orders")
    orders = orders.withColumn("o_orderdate", epoch_ns(orders, "o_orderdate"))
    last = F.col("o_orderkey") % 500
    damaged = orders.where(last != 11).withColumn("o_totalprice", F.when(last == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = orders.where(last == 17).withColumn("o_orderkey", -F.col("o_orderkey"))
    current = damaged.unionByName(orders.where(last == 13)).unionByName(new)
    depth = tree.depth_for(orders.count(), rows_per_leaf=256)
    then, now = (materialise(tree.marks(rows, ["o_orderkey"], depth), "order-marks") for rows in (orders, current))
    leaves, _ = tree.unequal_leaves(tree.nodes(then, depth), tree.nodes(now, depth), depth)
    return tree.differing_keys(then, now, leaves)
