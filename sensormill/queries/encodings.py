"""Canonical hashes and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.functions.canonical import digest_by, fingerprint, row_hash
from sensormill.functions.timing import epoch_ns
from sensormill.queries.registry import query, table


def _int(v: str) -> str:
    return f"coalesce('I' || CAST({v} AS VARCHAR) || ';', 'N;')"


def _text(v: str) -> str:
    return f"coalesce('S' || strlen({v}) || ':' || {v} || ';', 'N;')"


def _float(v: str) -> str:
    bits = f"CASE WHEN isnan({v}) THEN '7ff8000000000000' ELSE lower(hex(CAST({v} AS BIT)::BLOB)) END"
    return f"coalesce('F' || {bits} || ';', 'N;')"


def _row(**fields: str) -> str:
    named = "".join(f" || 'S{len(n)}:{n};' || {fields[n]}" for n in sorted(fields))
    return f"('M{len(fields)}:'{named} || ';')"


_ORDER_ROW = _row(
    o_orderkey=_int("o_orderkey"),
    o_custkey=_int("o_custkey"),
    o_orderstatus=_text("o_orderstatus"),
    o_totalprice=_float("o_totalprice"),
    order_ns=_int("epoch_ns(o_orderdate)"),
    o_orderpriority=_text("o_orderpriority"),
)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.withColumn("order_ns", epoch_ns(orders, "o_orderdate")).drop("o_orderdate")


@query(f"SELECT o_orderkey, sha256({_ORDER_ROW}) AS row_hash FROM orders")
def row_hash_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return orders.select("o_orderkey", row_hash(orders).alias("row_hash"))


_LINE_ROW = _row(
    l_orderkey=_int("l_orderkey"),
    l_partkey=_int("l_partkey"),
    l_suppkey=_int("l_suppkey"),
    l_linenumber=_int("l_linenumber"),
    l_quantity=_float("l_quantity"),
    l_extendedprice=_float("l_extendedprice"),
    l_discount=_float("l_discount"),
    l_tax=_float("l_tax"),
    l_returnflag=_text("l_returnflag"),
    l_linestatus=_text("l_linestatus"),
    ship_ns=_int("epoch_ns(l_shipdate)"),
)


@query(f"SELECT l_orderkey, l_linenumber, sha256({_LINE_ROW}) AS row_hash FROM lineitem")
def row_hash_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    lines = lines.withColumn("ship_ns", epoch_ns(lines, "l_shipdate")).drop("l_shipdate")
    return lines.select("l_orderkey", "l_linenumber", row_hash(lines).alias("row_hash"))


_VECTOR_ROW = _row(vec_id=_int("vec_id"), label=_int("label"), embedding="('L' || n || ':' || items || ';')")


@query(
    f"""WITH v AS (SELECT vec_id, label, len(embedding) AS n, unnest(range(len(embedding))) AS i,
    CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
e AS (SELECT vec_id, label, n, string_agg({_float("x")}, '' ORDER BY i) AS items FROM v GROUP BY vec_id, label, n)
SELECT vec_id, sha256({_VECTOR_ROW}) AS row_hash FROM e"""
)
def row_hash_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """An array of floats, widened to doubles, element by element in order."""
    vectors = table(spark, folder, "embeddings")
    return vectors.select("vec_id", row_hash(vectors).alias("row_hash"))


_PROPS = "'M1:S1:k;' || " + _int("CAST(json_extract_string(props, '$.k') AS BIGINT)") + " || ';'"


@query(f"SELECT event_id, sha256({_row(event_id=_int('event_id'), props=_PROPS)}) AS row_hash FROM events")
def row_hash_map(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", F.from_json("props", "map<string,bigint>").alias("props")
    )
    return events.select("event_id", row_hash(events).alias("row_hash"))


_NESTED = _row(
    c_custkey=_int("c_custkey"),
    in_debt="CASE WHEN c_acctbal < 0 THEN 'B1;' ELSE 'B0;' END",
    place=_row(segment=_text("c_mktsegment"), nation=_int("c_nationkey"), none="'N;'"),
)


@query(f"SELECT c_custkey, sha256({_NESTED}) AS row_hash FROM customer")
def row_hash_nested(spark: SparkSession, folder: str) -> DataFrame:
    """A nested row, a boolean and an explicit NULL."""
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") < 0).alias("in_debt"),
        F.struct(
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation"),
            F.lit(None).cast("string").alias("none"),
        ).alias("place"),
    )
    return customers.select("c_custkey", row_hash(customers).alias("row_hash"))


@query(
    """SELECT doc_id, sha256(CAST('M2:S6:doc_id;I' || doc_id || ';S4:text;Y' || strlen(text) || ':' AS BLOB)
  || encode(text) || CAST(';;' AS BLOB)) AS row_hash FROM documents"""
)
def row_hash_bytes(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", F.col("text").cast("binary").alias("text"))
    return documents.select("doc_id", row_hash(documents).alias("row_hash"))


_ITEM = "event_type || '|' || CAST(json_extract_string(props, '$.k') AS VARCHAR)"


@query(
    f"""SELECT user_id, sha256(string_agg(strlen(item) || ':' || item, '' ORDER BY item COLLATE "binary")) AS digest
FROM (SELECT user_id, {_ITEM} AS item FROM events) GROUP BY user_id""".replace(' COLLATE "binary"', "")
)
def digest_per_log(spark: SparkSession, folder: str) -> DataFrame:
    """The exact digest of a multiset with repeated items, per group."""
    items = table(spark, folder, "events").select(
        "user_id", F.concat_ws("|", "event_type", F.get_json_object("props", "$.k")).alias("item")
    )
    return digest_by(items, ["user_id"], "item")


_LANES = ", ".join(
    f"CAST(sum(CAST(('0x' || substr(h, {1 + 15 * i}, 15)) AS BIGINT)) AS VARCHAR) AS l{i}" for i in range(4)
)


@query(
    f"""SELECT o_orderstatus, n_rows, sha256(concat_ws('|', CAST(n_rows AS VARCHAR), l0, l1, l2, l3)) AS fingerprint
FROM (SELECT o_orderstatus, count(*) AS n_rows, {_LANES}
      FROM (SELECT o_orderstatus, sha256({_ORDER_ROW}) AS h FROM orders) GROUP BY o_orderstatus)"""
)
def fingerprint_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return fingerprint(orders, by=["o_orderstatus"])
