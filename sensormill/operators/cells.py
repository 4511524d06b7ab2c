"""Exact nearest vectors with pruning: cells around pivots, and the triangle inequality.

Unit vectors are dealt to their nearest pivot and, by their distance to it, into shells around it: these are the cells. A
cell knows the least and the largest distance to its pivot. No vector of a cell can be nearer to a query than the query's
distance to the pivot differs from these, so a cell whose best possible score is below the query's k-th score so far holds
no hit and is not looked into; a few outliers around a pivot do not spoil its inner shells. Two rounds suffice: the first looks into each
query's most promising cells until they hold k vectors and so sets the bar, the second into all others that may reach it.

How much is saved depends on the vectors alone: clusters are pruned well, vectors spread evenly in many dimensions hardly
at all. The result is the same either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.operators.retrieval import QUERIES_PER_BLOCK, ROWS_PER_SHARD, best_of_shard, unit_rows, usable
from sensormill.workspace import materialise

#: Cells for vectors that have no direction, and for vectors of a length no pivot has: always of use.
ZERO, NO_PIVOT = -2, -1
#: Shells around a pivot, and their width; no two unit vectors are further apart than 2.
SHELLS, WIDTH = 16, 0.125
#: Distances are sums of rounded products; a bound is loosened by this much.
SLACK = 1e-9


class Pivots:
    """At most a fixed number of unit vectors, by their length; they are part of what every task gets."""

    def __init__(self, vectors: list[list[float]]):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        filled = [v for v in vectors if any(v)]
        for length in {len(v) for v in filled}:
            numbers = [i for i, v in enumerate(filled) if len(v) == length]
            self.by_length[length] = np.array(numbers), unit_rows(pd.Series([filled[i] for i in numbers]))

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pivots of the vectors' length, and the distance of each vector to each."""
        numbers, pivots = self.by_length[unit.shape[1]]
        return numbers, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (unit @ pivots.T)))


def _place(pivots: Pivots):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, far = np.full(len(batch), NO_PIVOT), np.full(len(batch), np.inf)
            lengths = batch["_vector"].map(len).to_numpy()
            for length in set(lengths.tolist()) & set(pivots.by_length):
                own = np.flatnonzero(lengths == length)
                unit = unit_rows(batch["_vector"].iloc[own])
                numbers, distance = pivots.distances(unit)
                nearest = np.argmin(distance, axis=1)
                far[own] = distance[np.arange(len(own)), nearest]
                cell[own] = numbers[nearest] * SHELLS + np.minimum(far[own] // WIDTH, SHELLS - 1).astype(np.int64)
                cell[own[~unit.any(axis=1)]] = ZERO
            yield batch.assign(_cell=cell, _far=far)

    return run


def _bounds(pivots: Pivots, sizes: dict[int, int], rims: dict[int, tuple[float, float]], k: int):
    """For every query all cells in order of the best score they may hold, and how many of them set the bar."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells, best, first = [], [], []
            for vector in batch["_vector"]:
                unit = unit_rows(pd.Series([vector]))
                scores, sure = {c: 1.0 for c in sizes}, set()
                if ZERO in scores:
                    scores[ZERO] = 0.0
                if not unit.any():
                    scores = dict.fromkeys(scores, 0.0)  # every score of an all-zero query is 0
                elif unit.shape[1] in pivots.by_length:
                    numbers, distance = pivots.distances(unit)
                    at = dict(zip(numbers.tolist(), distance[0].tolist(), strict=True))
                    for c, (near, far) in rims.items():
                        d = at.get(c // SHELLS) if c >= 0 else None
                        if d is not None:
                            sure.add(c)
                            scores[c] = 1.0 - max(0.0, d - far - SLACK, near - d - SLACK) ** 2 / 2.0
                order = sorted(scores, key=lambda c: (-scores[c], c))
                # Only vectors that are known to have the query's length count towards the k.
                covered = np.cumsum([sizes[c] if c in sure else 0 for c in order])
                cells.append(order)
                best.append([scores[c] for c in order])
                first.append(min(len(order), int(np.searchsorted(covered, k)) + 1))
            yield batch.assign(_cells=cells, _best=best, _first=first)

    return run


def top_vectors_by_cells(
    corpus: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector: str = "embedding", digits: int = 6, pivots: int = 256
) -> tuple[DataFrame, DataFrame]:
    """What ``top_vectors`` gives, and per query: n_cells, n_visited, n_rows and n_scored.

    The pivots are the ``pivots`` vectors of smallest hash, from all rows. Large cells are dealt into shards and the
    queries into blocks; a shard goes only to blocks with a query that looks into its cell. Vectors that are NULL or hold
    a NULL or non-finite component take no part.
    """
    spark = corpus.sparkSession
    item_type, query_type = corpus.schema[id_column].dataType, queries.schema["query_id"].dataType
    asked = materialise(queries.where(usable(F.col("vector"))).select("query_id", F.col("vector").cast("array<double>").alias("_vector")), "query-vectors")
    rows = corpus.where(usable(F.col(vector))).select(F.col(id_column).alias("_item"), F.col(vector).cast("array<double>").alias("_vector"))
    chosen = rows.where(F.size("_vector") > 0).orderBy(F.xxhash64("_item"), "_item", "_vector").limit(pivots).collect()
    own = Pivots([list(r["_vector"]) for r in chosen])
    row_type = T.StructType([*rows.schema.fields, T.StructField("_cell", T.LongType()), T.StructField("_far", T.DoubleType())])
    placed = materialise(rows.mapInPandas(_place(own), row_type), "placed-vectors")
    cells = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.min("_far").alias("near"), F.max("_far").alias("far")).collect()  # SHELLS * pivots at most
    sizes, rims = {c["_cell"]: c["n"] for c in cells}, {c["_cell"]: (c["near"], c["far"]) for c in cells}
    plan_type = T.StructType([
        *asked.schema.fields,
        T.StructField("_cells", T.ArrayType(T.LongType())), T.StructField("_best", T.ArrayType(T.DoubleType())), T.StructField("_first", T.IntegerType()),
    ])
    planned = materialise(asked.mapInPandas(_bounds(own, sizes, rims, k), plan_type), "planned-queries")
    blocks = max(1, -(-planned.count() // QUERIES_PER_BLOCK))
    shards = spark.createDataFrame(
        [(c, max(1, -(-n // ROWS_PER_SHARD))) for c, n in sizes.items()], T.StructType.fromDDL("_cell BIGINT, _shards INT")
    )
    out = T.StructType([T.StructField("query_id", query_type), T.StructField("item_id", item_type), T.StructField("score", T.DoubleType())])

    def look(visits: DataFrame) -> DataFrame:
        """The k best of every visited cell's shards."""
        left = visits.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        wanted = left.select(F.col("_cell").alias("_wanted"), F.col("_block").alias("_at")).distinct()
        left = left.join(shards, "_cell").withColumn("_shard", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1))).drop("_shards")
        right = placed.join(shards, "_cell").withColumn("_shard", F.pmod(F.xxhash64("_item"), F.col("_shards")).cast("int")).drop("_shards", "_far")
        right = right.join(wanted, F.col("_cell") == F.col("_wanted")).drop("_wanted")
        met = left.groupBy("_cell", "_shard", "_block").cogroup(right.groupBy("_cell", "_shard", "_at"))
        return met.applyInPandas(best_of_shard(k, digits), out)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    nearest = planned.select("query_id", "_vector", F.explode(F.slice("_cells", F.lit(1), F.col("_first"))).alias("_cell"))
    first = materialise(ranked(look(nearest)).drop("rank"), "first-hits")
    bar = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("_bar"))
    # Scores are compared after rounding: a cell may matter if its best score comes within one unit of the last digit.
    reach = F.coalesce(F.col("_bar") - F.lit(10.0**-digits), F.lit(-2.0))
    others = F.expr("slice(arrays_zip(_cells, _best), _first + 1, greatest(size(_cells) - _first, 0))")
    still = planned.join(bar, "query_id", "left").withColumn("_open", F.filter(others, lambda c: c["_best"] >= reach))
    still = materialise(still.select("query_id", "_vector", "_cells", "_first", "_open"), "open-cells")
    second = look(still.select("query_id", "_vector", F.explode("_open._cells").alias("_cell")))
    sized = F.create_map(*(x for c, n in sizes.items() for x in (F.lit(c), F.lit(n).cast("bigint")))) if sizes else F.create_map().cast("map<bigint,bigint>")
    visited = F.concat(F.slice("_cells", F.lit(1), F.col("_first")), F.col("_open._cells"))
    scored = F.aggregate(visited, F.lit(0).cast("bigint"), lambda s, c: s + F.element_at(sized, c))
    figures = still.select(
        "query_id", F.size("_cells").alias("n_cells"), F.size(visited).alias("n_visited"),
        F.lit(sum(sizes.values())).cast("bigint").alias("n_rows"), scored.alias("n_scored"),
    )
    return ranked(first.unionByName(second)), figures
