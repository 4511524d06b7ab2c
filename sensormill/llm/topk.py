"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Vectors are taken as sparse rows of integers: component x becomes floor(1024 * x) and zeros vanish. The candidates of a
task form an inverted index, term -> (rows, weights). A query walks its own terms and scatters weight times posting into
a dense array of scores, from which partition selection takes its k best; these merge with the best so far.

Queries come in blocks and candidates in shards. A task is one (block, shard): the block's queries stand in memory (at
most ``BLOCK`` of them), the shard's candidates pass in Arrow batches. Each task returns k rows per query, which one
small window merges. Every query meets every candidate; nothing is broadcast and nothing is collected.

NULL vectors, vectors with a NULL or non-finite component and rows without an id take no part. Vectors of different
lengths count as filled with zeros; an empty one scores 0. Rows with a query's id count as its own and are no candidates
for it; repeated query rows count once. Ties go to the smaller id. Scores beyond 64 bits are set to the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
SHARD = 65536
SCALE = 1024.0
_LIMIT = (1 << 63) - 1


def quantised(values: np.ndarray) -> np.ndarray:
    """Integers; Python's own where 64 bits might not do for a product."""
    whole = np.floor(SCALE * values.astype(np.float64))
    if len(whole) and np.abs(whole).max() >= 1 << 24:
        return np.array([int(v) for v in whole], dtype=object)
    return whole.astype(np.int64)


class Postings:
    """Inverted index of some candidates: per term the rows that have it, and their weights."""

    def __init__(self, offsets: np.ndarray, values: np.ndarray):
        self.count = len(offsets) - 1
        sizes = np.diff(offsets)
        self.wide = values.dtype == object
        rows = np.repeat(np.arange(self.count), sizes)
        terms = np.arange(len(values)) - np.repeat(offsets[:-1], sizes)
        filled = np.flatnonzero(values != 0)
        order = filled[np.argsort(terms[filled], kind="stable")]
        bounds = np.searchsorted(terms[order], np.arange((int(sizes.max()) if self.count else 0) + 1))
        self.lists = []
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            own = order[begin:end]
            full = len(own) == self.count
            self.lists.append((slice(None) if full else rows[own], values[own]))

    def scores(self, query: np.ndarray) -> np.ndarray:
        wide = self.wide or query.dtype == object
        out = np.zeros(self.count, dtype=object if wide else np.int64)
        for term in np.flatnonzero(query[: len(self.lists)] != 0):
            rows, weights = self.lists[term]
            out[rows] += query[term] * weights  # a row has a term once
        return np.array([max(min(int(v), _LIMIT), -_LIMIT - 1) for v in out], dtype=np.int64) if wide else out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id; ``ids`` ascend."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        keep = np.concatenate([above, np.flatnonzero(scores == edge)[: k - len(above)]])
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, ~scores))  # ~ turns the order around without overflow
    return scores[order], ids[order]


def _group_runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, bool], int, int]]:
    block, shard, is_row = (batch[c].to_numpy(zero_copy_only=False) for c in ("block", "shard", "is_row"))
    change = np.flatnonzero((block[1:] != block[:-1]) | (shard[1:] != shard[:-1]) | (is_row[1:] != is_row[:-1])) + 1
    for begin, end in zip([0, *change.tolist()], [*change.tolist(), len(block)], strict=True):
        yield (int(block[begin]), int(shard[begin]), bool(is_row[begin])), begin, end


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows (vec_id, embedding) of ``queries`` against all of ``vectors``."""
    spark = vectors.sparkSession

    def usable(rows: DataFrame) -> DataFrame:
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        cleaned = rows.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
        return cleaned.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)

    candidates, asked = usable(vectors), usable(queries).dropDuplicates()
    n_rows, n_queries = candidates.count(), asked.count()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, shards = max(1, -(-n_queries // BLOCK)), max(1, -(-n_rows // SHARD), min(parallel, -(-n_rows // 1024)))
    code = F.xxhash64("vec_id", "embedding")
    asked = asked.select(
        F.pmod(code, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.lit(False).alias("is_row"), "vec_id", code.alias("code"), "embedding",
    )
    rows = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(True).alias("is_row"), "vec_id", F.lit(0).cast("bigint").alias("code"), "embedding",
    )

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def finished() -> Iterator[pa.RecordBatch]:
            sizes = [len(q[3]) for q in held]
            if sum(sizes):
                columns = [
                    pa.array(np.repeat([q[0] for q in held], sizes).astype(np.int64)),
                    pa.array(np.repeat([q[1] for q in held], sizes).astype(np.int64)),
                    pa.array(np.concatenate([q[4] for q in held])),
                    pa.array(np.concatenate([q[3] for q in held])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "code", "vec_id", "score"])

        for batch in batches:
            for (block, shard, is_row), begin, end in _group_runs(batch) if batch.num_rows else ():
                if (block, shard) != current:
                    yield from finished()
                    current, held = (block, shard), []
                part = batch.slice(begin, end - begin)
                lists = part["embedding"]
                offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                values = quantised(lists.flatten().to_numpy(zero_copy_only=False))
                ids = part["vec_id"].to_numpy()
                if not is_row:
                    none = np.zeros(0, dtype=np.int64)
                    for i, (own, mark) in enumerate(zip(ids.tolist(), part["code"].to_pylist(), strict=True)):
                        held.append([own, mark, values[offsets[i] : offsets[i + 1]], none, none])
                    continue
                index = Postings(offsets, values)
                for query in held:
                    scores, own = index.scores(query[2]), ids
                    at = np.searchsorted(ids, query[0])
                    if at < len(ids) and ids[at] == query[0]:
                        other = ids != query[0]
                        scores, own = scores[other], ids[other]
                    new_scores, new_ids = best(scores, own, k)
                    both_scores, both_ids = np.concatenate([query[3], new_scores]), np.concatenate([query[4], new_ids])
                    order = np.argsort(both_ids, kind="stable")
                    query[3], query[4] = best(both_scores[order], both_ids[order], k)
        yield from finished()

    dealt = asked.unionByName(rows).repartition("block", "shard").sortWithinPartitions("block", "shard", "is_row", "vec_id")
    found = dealt.mapInArrow(accumulate, "query_id long, code long, vec_id long, score long")
    place = Window.partitionBy("query_id", "code").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
