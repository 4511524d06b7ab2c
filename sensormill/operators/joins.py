"""Equi-joins in which NULL keys match each other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with ``<=>``; the result has the keys of the left side once.

    No side carries a broadcast hint: Spark broadcasts by measured size and otherwise shuffles on the keys, where
    adaptive execution splits a hot key of the left side.
    """
    marked = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    joined = left.join(marked, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"_r_{k}" for k in keys))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order``; combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *(F.col(f"_row.`{c}`").alias(c) for c in rest))
