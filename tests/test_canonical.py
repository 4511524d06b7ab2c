import hashlib
import math
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.functions.canonical import digest_by, encode_row, fingerprint, row_hash

GOLDEN = "8e28ca6475dcf4fdc1c98bb546b0955563eeb9721893b6bd7a979521b836e5ad"


def hashes(spark, ddl, *rows):
    df = spark.createDataFrame(list(rows), ddl)
    return [r[0] for r in df.select(row_hash(df)).collect()]


def encoded(spark, ddl, row, columns=None):
    df = spark.createDataFrame([row], ddl)
    value = df.select(encode_row(df, columns)).first()[0]
    return value.encode() if isinstance(value, str) else bytes(value)


def test_golden_vector(spark):
    row = ("0bae3b5e", 315969538559783000, -0.0, None)
    assert hashes(spark, "log_id string, timestamp_ns bigint, v double, n string", row) == [GOLDEN]


def test_column_order_does_not_matter(spark):
    assert encoded(spark, "a int, b string", (1, "x")) == encoded(spark, "b string, a int", ("x", 1))


def test_null_and_empty_string_differ(spark):
    assert len(set(hashes(spark, "a string", (None,), ("",)))) == 2


def test_doubles_keep_their_bits_and_all_nans_are_one(spark):
    other_nan = struct.unpack(">d", bytes.fromhex("fff8000000000001"))[0]
    values = [0.0, -0.0, math.nan, other_nan, math.inf, -math.inf, 5e-324, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r[0] for r in df.select(encode_row(df)).collect()]
    bits = ["7ff8000000000000" if math.isnan(v) else struct.pack(">d", v).hex() for v in values]
    assert found == [f"M1:S1:x;F{b};;" for b in bits]


def test_one_and_one_point_zero_differ_and_floats_widen(spark):
    assert hashes(spark, "x int", (1,)) != hashes(spark, "x double", (1.0,))
    assert hashes(spark, "x float", (1.5,)) == hashes(spark, "x double", (1.5,))
    assert hashes(spark, "x smallint", (1,)) == hashes(spark, "x bigint", (1,))


def test_maps_sort_keys_and_lists_keep_order(spark):
    assert encoded(spark, "m map<string,int>", ({"b": 1, "a": 2},)) == b"M1:S1:m;M2:S1:a;I2;S1:b;I1;;;"
    assert encoded(spark, "m map<int,int>", ({10: 1, 9: 2},)) == b"M1:S1:m;M2:S2:10;I1;S1:9;I2;;;"
    assert len(set(hashes(spark, "l array<int>", ([1, 2],), ([2, 1],), ([1, None],), (None,), ([],)))) == 5


def test_bytes_nested_rows_and_non_ascii(spark):
    row = (bytearray(b"\x00\xff"), ("é", True), [bytearray(b"a"), None])
    assert (
        encoded(spark, "y binary, s struct<q:string,p:boolean>, l array<binary>", row)
        == b"M3:S1:l;L2:Y1:a;N;;S1:s;M2:S1:p;B1;S1:q;S2:\xc3\xa9;;S1:y;Y2:\x00\xff;;"
    )


@pytest.mark.parametrize("dtype", ["date", "timestamp", "decimal(5,2)", "array<date>", "map<double,int>", "struct<d:date>"])
def test_other_types_are_refused_while_the_plan_is_built(spark, dtype):
    df = spark.createDataFrame([], f"x {dtype}")
    with pytest.raises(TypeError):
        encode_row(df)


def test_digest_is_exact_order_independent_and_framed(spark):
    rows = [("g", b"ab"), ("g", b"c"), ("g", b"c"), ("h", b"a"), ("h", b"bc"), ("i", b"abc"), (None, b"x")]
    df = spark.createDataFrame(rows, "k string, item binary")
    found = {r.k: r.digest for r in digest_by(df, ["k"], "item").collect()}
    mirrored = {r.k: r.digest for r in digest_by(df.orderBy(F.desc("item")).repartition(3), ["k"], "item").collect()}
    assert found == mirrored
    assert found["g"] == hashlib.sha256(b"2:ab1:c1:c").hexdigest()
    assert found["h"] == hashlib.sha256(b"1:a2:bc").hexdigest()
    assert len(set(found.values())) == 4
    assert digest_by(df.drop("k"), [], "item").first().digest == hashlib.sha256(b"1:a2:ab3:abc2:bc1:c1:c1:x").hexdigest()


def test_digest_of_a_group_spanning_many_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("item"))
        found = {r.k: r.digest for r in digest_by(df, ["k"], "item").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in (0, 1):
        items = sorted(str(i).encode() for i in range(1000) if i % 2 == k)
        assert found[k] == hashlib.sha256(b"".join(b"%d:%b" % (len(i), i) for i in items)).hexdigest()


def test_fingerprint_sees_duplicates_and_changes_but_not_order(spark):
    df = spark.range(200).select("id", (F.col("id") * 0.5).alias("v"))
    base = fingerprint(df).first()
    assert fingerprint(df.orderBy(F.desc("id")).repartition(7)).first() == base
    assert fingerprint(df.union(df.limit(1))).first().fingerprint != base.fingerprint
    assert fingerprint(df.where("id <> 7")).first().fingerprint != base.fingerprint
    moved = df.withColumn("v", F.when(F.col("id") == 3, -0.0).otherwise(F.col("v")))
    assert fingerprint(moved).first().fingerprint != base.fingerprint
    assert fingerprint(spark.createDataFrame([], T.StructType(df.schema.fields))).first().n_rows == 0
