"""Tiles of bounded size and the pairs of tiles that must meet: the block joins of words and of vectors.

Rows carry a cell, a tuple of whole numbers such that rows which may match lie in cells that differ by one of a few
known offsets. A cell of many rows is dealt into tiles by hash, so no row of the tile table outgrows its bound, and what
is compared is one pair of tiles at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormill.workspace import materialise

Offset = tuple[int, ...]


def dealt(rows: DataFrame, cell: list[str], key: str, room: Column) -> DataFrame:
    """``rows`` with ``tile``: the name of a part of their cell that holds about ``room`` rows.

    ``room`` is an expression of the cell. Only row counts per cell are gathered by a join, never rows.
    """
    counts = rows.groupBy(*cell).count().select(*cell, F.ceil(F.col("count") / room).cast("long").alias("_parts"))
    part = F.pmod(F.xxhash64(key), F.col("_parts"))
    return rows.join(counts, cell).withColumn("tile", F.concat_ws(":", *cell, part)).drop("_parts")


def gathered(rows: DataFrame, cell: list[str], content: Column, *extra: Column) -> DataFrame:
    """(tile, cell, members, extra aggregates), one row per tile.

    Grouped by the tile alone: with the cell in the key Spark would leave all tiles of a large cell in one task.
    """
    first = (F.first(c).alias(c) for c in cell)
    return rows.groupBy("tile").agg(*first, F.collect_list(content).alias("members"), *extra)


def meetings(tiles: DataFrame, cell: list[str], offsets: Iterable[Offset], others: list[str] | None = None) -> DataFrame:
    """(tile_a, tile_b, and the columns ``others`` of both sides) for all tiles whose cells differ by one of ``offsets``.

    ``offsets`` name each neighbourhood from one of its two sides only; the zero offset is the cell itself, whose tiles
    meet each other once and themselves.
    """
    others = others or []
    moves = F.array(*(F.struct(*(F.lit(step).cast("long").alias(c) for c, step in zip(cell, offset, strict=True))) for offset in offsets))
    left = tiles.select(F.col("tile").alias("tile_a"), *(F.col(c).alias(f"{c}_a") for c in others), *cell, F.explode(moves).alias("_move"))
    own = F.lit(True)
    for c in cell:
        own = own & (F.col("_move")[c] == 0)
    left = left.withColumn("_own", own).withColumns({c: F.col(c) + F.col("_move")[c] for c in cell}).drop("_move")
    right = tiles.select(F.col("tile").alias("tile_b"), *(F.col(c).alias(f"{c}_b") for c in others), *cell)
    met = left.join(right, cell).filter(~F.col("_own") | (F.col("tile_a") <= F.col("tile_b")))
    return met.select("tile_a", "tile_b", *(f"{c}_{side}" for side in "ab" for c in others))


def brought_together(pairs: DataFrame, tiles: DataFrame, label: str) -> DataFrame:
    """(tile_a, tile_b, members_a, members_b): the content of both tiles of every pair, spread evenly over tasks.

    The number of tasks is explicit: adaptive execution would merge them by bytes, and a pair costs time, not bytes.
    """
    spark = pairs.sparkSession
    number = materialise(pairs.select("tile_a", "tile_b"), label)
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    one = tiles.select(F.col("tile").alias("tile_a"), F.col("members").alias("members_a"))
    two = tiles.select(F.col("tile").alias("tile_b"), F.col("members").alias("members_b"))
    return number.join(one, "tile_a").join(two, "tile_b").repartition(slots, "tile_a", "tile_b")
