"""Very long texts, vectors and urls, empty tables and clashing columns in operators whose own tests lack them."""

import hashlib
import time

import numpy as np
from pyspark.sql import functions as F

from sensormill.llm import collocations, embedding_dedup, html_tree, mixing, quality, queries, secret_ledger, spelling, topk, urls

LONG = 3_000_000


def repeated(spark, word, times=LONG):
    """One row whose text is made by Spark, so it does not travel as a literal."""
    return spark.range(1).select(F.col("id").alias("doc_id"), F.expr(f"repeat('{word}', {times // len(word)})").alias("text"))


def test_long_texts_are_scored_and_mixed(spark):
    docs = repeated(spark, "good words here ").unionByName(spark.createDataFrame([(1, "good", ), (2, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert sorted(r.doc_id for r in scored) == [0, 1, 2] and all(0 <= r.p_top <= r.expected_grade <= 2 for r in scored)
    sourced = docs.withColumns({"source": F.lit("s"), "lang": F.lit("en"), "n_chars": F.length("text"), "size": F.lit("x"), "target": F.lit(1)})
    mixed = {r.doc_id: r for r in mixing.mixed(sourced).collect()}
    assert mixed[0].size == 3 * (LONG // 16) and mixed[2].size == 0
    assert all(r.taken <= 2 * r.size for r in mixed.values())
    total = sum(r.size for r in mixed.values())
    assert abs(sum(r.taken for r in mixed.values()) - 1.5 * total) <= total
    assert mixing.mixed(spark.createDataFrame([], sourced.schema)).count() == 0


def test_long_vectors_and_urls(spark):
    wide = np.linspace(-1, 1, 20_000)
    rows = [(i, (wide * (i + 1)).tolist()) for i in range(4)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    quantised = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64)
    found = topk.top_k(vectors, vectors.filter("vec_id = 0"), k=2).collect()
    assert sorted((r.vec_id, r.score) for r in found) == [(i, int(quantised[0] @ quantised[i])) for i in (2, 3)]
    shorter = spark.createDataFrame([(i, v[:1500]) for i, v in rows], vectors.schema)
    assert {(r.n_links, r.component_id) for r in embedding_dedup.near_copies(shorter).collect()} == {(3, 0)}
    pages = spark.range(1).select(F.col("id").alias("page_id"), F.concat(F.lit("http://Example.org/es/"), F.expr(f"repeat('a-', {LONG // 2})")).alias("url"))
    judged = urls.judge(pages).first()
    assert (judged.host, judged.rule, judged.verdict, len(judged.path)) == ("example.org", "example.org/es/", "block", LONG // 2 * 2 + 4)


def test_long_texts_of_words_and_secrets(spark):
    text = "secret=abcdef " + "xy" * (LONG // 2)
    found = secret_ledger.findings(spark.createDataFrame([(1, text)], "doc_id long, text string"))[0].first()
    assert (found.n_assign, found.base_sha256) == (1, hashlib.sha256(b"assign:0:13").hexdigest())
    many = repeated(spark, "Alpha beta, ")
    assert [(r.word, r.n, r.root) for r in spelling.variants(many, slip=None).collect()] == [("alpha", LONG // 12, "alpha")]
    one = collocations.collocations(many.withColumn("lang", F.lit("en"))).collect()
    assert [(r.phrase, r.a, r.n) for r in one] == [("alpha beta", LONG // 12, 2 * (LONG // 12))]


def test_a_long_page(spark):
    pages = spark.range(1).select(
        F.col("id").alias("page_id"), F.lit("http://h.x/").alias("url"),
        F.concat(F.lit("<body><article>"), F.expr(f"repeat('<p>some &amp; words</p>', {LONG // 23})"), F.lit("</article></body>")).alias("html"),
    )
    start = time.perf_counter()
    row = html_tree.extract(pages).first()
    assert row.n_chars == len("some & words\n") * (LONG // 23) - 1 and time.perf_counter() - start < 60


def test_the_quality_query_returns_every_document(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.op2_quality_classifier(spark, folder)
    assert found.columns == ["doc_id", "expected_grade", "p_top", "selected"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert found.count() == docs.count() and found.filter(F.col("selected") != (F.col("p_top") >= quality.LEAST)).count() == 0
