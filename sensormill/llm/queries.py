"""The operators as named queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensormill.llm import (
    collocations,
    decontaminate,
    embedding_dedup,
    html_tree,
    jaccard,
    mixing,
    oracles,
    quality,
    secret_ledger,
    spelling,
    substring_dedup,
    suffix_dedup,
    topk,
    urls,
)
from sensormill.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


@query()
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words under 13-word windows that an earlier document holds are removed."""
    return substring_dedup.remove_repeats(table(spark, folder, "documents"), width=13)


@query()
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and chance of the top grade of every document, and whether it is selected."""
    docs = table(spark, folder, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", "expected_grade", "p_top", (scored.p_top >= quality.LEAST).alias("selected"))


@query()
def op3_mixing_to_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes from every document, by entropy balancing per source."""
    return mixing.mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of documents inside any occurrence of ten consecutive benchmark words."""
    return decontaminate.find_spans(table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10)


@query(
    """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""
)
def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest integer inner products of every vector whose id is divisible by 100."""
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def _url_sql() -> str:
    def hit(term: str) -> str:
        return f"CAST(regexp_matches(u, '(^|[^a-z0-9]){term}($|[^a-z0-9])') AS INTEGER)"

    cases = ["CASE"]
    for decision, text in sorted(urls.RULES, key=lambda r: -len(r[1])):
        host, _, path = text.partition("/")
        fits = f"(host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '/{path}')"
        cases.append(f"WHEN {fits} THEN '{decision} {text}'")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, translate(coalesce(url, ''), '{upper}', '{lower}') AS u FROM pages),
h AS (
  SELECT page_id, u, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{upper}', '{lower}') AS host,
         regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM p),
r AS (
  SELECT *, {" ".join(cases)} END AS r,
         {" + ".join(hit(t) for t in urls.STRICT)} AS strict_terms, {" + ".join(hit(t) for t in urls.SOFT)} AS soft FROM h)
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule,
       CASE WHEN r IS NOT NULL THEN split_part(r, ' ', 1) WHEN strict_terms > 0 OR soft >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


@query()
def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document at 0.8 over five-word shingles."""
    return jaccard.linked(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


@query()
def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes under 400-byte strings that start more than once are removed."""
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), width=400)


@query(_url_sql())
def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Host rules and weighted url vocabulary."""
    return urls.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query()
def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page by the style tree of its site."""
    return html_tree.extract(table(spark, folder, "pages"))


@query()
def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, found once per distinct text."""
    found, _ = secret_ledger.findings(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query(oracles.SPELLING)
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word with its near words, its more frequent form and its root."""
    return spelling.variants(table(spark, folder, "documents")).select("word", "n", "n_near", "form", "form_n", "root")


@query(oracles.EMBEDDINGS)
def op12_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links at a cosine of 0.95 and the component of every vector."""
    found = embedding_dedup.near_copies(table(spark, folder, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


@query(oracles.COLLOCATIONS)
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 strongest phrases of each language."""
    return collocations.collocations(table(spark, folder, "documents"))
