"""Exact top-k against plain products, and the url filter against its SQL and single cases."""

import duckdb
import numpy as np
import pytest

from sensormill.llm import queries, topk, urls

NAN, INF = float("nan"), float("inf")


def expected(rows, k):
    usable = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if i is not None and v is not None
              and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for query, own in usable.items():
        if query % 10 == 0:
            scores = [(sum(a * b for a, b in zip(own, v, strict=False)), i) for i, v in usable.items() if i != query]
            scores = [(-max(-(1 << 63), min((1 << 63) - 1, s)), i) for s, i in scores]
            out += [(query, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("wide", [1.0, 1e9])
def test_top_k(spark, small_batches, monkeypatch, wide):
    monkeypatch.setattr(topk, "BLOCK", 3)
    monkeypatch.setattr(topk, "SHARD", 16)
    generator = np.random.default_rng(1)
    rows = [(i, (wide * generator.integers(-3, 4, 6) / 7).tolist()) for i in range(70)]
    rows += [(i, rows[5][1]) for i in range(70, 100)]  # ties
    rows += [(101, None), (102, [1.0, None]), (103, [NAN]), (104, [INF, 1.0]), (105, []), (110, [0.5]), (None, [1.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    found = topk.top_k(vectors, vectors.filter("vec_id % 10 = 0"), k=4)
    assert sorted(map(tuple, found.collect())) == expected(rows, 4)


def test_repeated_queries_and_few_candidates(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    found = topk.top_k(vectors, vectors.filter("vec_id = 0"), k=10)
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 2048 * 1024)]
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    assert topk.top_k(vectors.limit(0), vectors).count() == 0


URLS = [
    None, "", "no scheme", "://", "HTTP://Example.ORG/es/x?y=://z", "http://example.org/en/12", "http://example.org/en/2",
    "http://notexample.org/es/1", "http://a.example.org/es/", "http://org", "http://org/", "http://x.com/fr/a", "http://com/de/",
    "http://x.net/casino", "http://x.net/casinos9", "http://cheap-pills.net/", "http://cheap-cheap.net/", "http://freepills.net",
    "http://x.net/ADULT", "http://éadult.net/", "http://x.net/a?q=free#win", "http://x.com/de/\nadult", "http://x.net?path", "http://user@x.org:80/p",
]


def test_urls_equal_their_sql(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, host VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(queries.ORACLES["op8_url_filters"]).fetchall())
    verdict = {URLS[r.page_id % len(URLS)]: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert verdict["HTTP://Example.ORG/es/x?y=://z"] == ("example.org", "/es/x", "example.org/es/", "block")
    assert verdict["http://example.org/en/12"][2:] == ("example.org/en/1", "block")
    assert verdict["http://notexample.org/es/1"][2:] == ("org/", "allow")
    assert verdict["http://org"] == ("org", "", None, "allow") and verdict[None] == ("", "", None, "allow")
    assert verdict["http://x.net/casino"][3] == "block" and verdict["http://x.net/casinos9"][3] == "allow"
    assert verdict["http://cheap-pills.net/"][3] == "block" and verdict["http://cheap-cheap.net/"][3] == "allow"
    assert urls.judge(pages.limit(0)).count() == 0
