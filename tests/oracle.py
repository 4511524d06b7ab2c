"""Run the registered queries beside their SQL and compare whole results: python tests/oracle.py [folder] [names]."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in wanted:
        start = time.time()
        try:
            names, got = spark_rows(queries()[name](spark, folder))
            took = time.time() - start
            if name not in oracle_sql():
                print(f"rows {name} {sum(got.values())} {took:.2f}s", flush=True)
                continue
            expected_names, expected = sql_rows(con, oracle_sql()[name])
            ok = names == expected_names and got == expected
            print(f"{'ok  ' if ok else 'BAD '} {name} {sum(got.values())} rows {took:.2f}s", flush=True)
            if not ok:
                failed += 1
                print("   ", names, expected_names)
                print("    only spark:", list((got - expected).items())[:3], sum((got - expected).values()))
                print("    only sql:  ", list((expected - got).items())[:3], sum((expected - got).values()))
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"ERR  {name} {type(e).__name__}: {str(e)[:600]}", flush=True)
    print(f"{len(wanted)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
