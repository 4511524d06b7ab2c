"""A tree of fingerprints over ranges of keys: it finds the rows that differ by descending only where it differs.

A row belongs to the leaf that the hash of its key begins with, so equal keys meet and leaves hold like numbers of rows
whatever the keys are. A leaf is the number of its rows and the sum of their hashes, a node above it the sum of its
children: sums combine before any shuffle. Two trees of the same depth are compared from the root; below equal nodes
nothing is looked at. What is left are the leaves whose rows must be compared one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.functions.canonical import row_hash
from sensormill.workspace import materialise

#: Rows a leaf holds, about; each level has 16 times as many nodes as the one above.
ROWS_PER_LEAF = 4096
DEEPEST = 12
_LANES, _DIGITS = 4, 15
_SUMS = [f"_l{i}" for i in range(_LANES)]


def depth_for(n_rows: int, rows_per_leaf: int = ROWS_PER_LEAF) -> int:
    depth = 0
    while depth < DEEPEST and n_rows > rows_per_leaf * 16**depth:
        depth += 1
    return depth


def marks(df: DataFrame, keys: Sequence[str], depth: int, columns: Sequence[str] | None = None) -> DataFrame:
    """(leaf, key, row_hash, copies): what a leaf needs to know of its rows. ``key`` is JSON; equal rows are counted."""
    hashed = df.select(
        F.substring(row_hash(df, keys), 1, depth).alias("leaf"),
        F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key"),
        row_hash(df, columns).alias("row_hash"),
    )
    return hashed.groupBy("leaf", "key", "row_hash").agg(F.count(F.lit(1)).alias("copies"))


def nodes(marked: DataFrame, depth: int) -> DataFrame:
    """(path, n_rows, fingerprint) of all nodes from the leaves up to the root, whose path is empty."""
    parts = [
        (F.conv(F.substring("row_hash", 1 + i * _DIGITS, _DIGITS), 16, 10).cast("decimal(20,0)") * F.col("copies")).cast("decimal(38,0)").alias(name)
        for i, name in enumerate(_SUMS)
    ]
    leaves = marked.select("leaf", "copies", *parts).groupBy("leaf").agg(F.sum("copies").alias("n_rows"), *(F.sum(c).alias(c) for c in _SUMS))
    above = F.explode(F.array(*(F.substring("leaf", 1, length) for length in range(depth + 1)))).alias("path")
    sums = leaves.select(above, "n_rows", *_SUMS).groupBy("path").agg(F.sum("n_rows").alias("n_rows"), *(F.sum(c).alias(c) for c in _SUMS))
    text = F.concat_ws("|", F.col("n_rows").cast("string"), *(F.col(c).cast("string") for c in _SUMS))
    return sums.select("path", "n_rows", F.sha2(text, 256).alias("fingerprint"))


def unequal_leaves(pinned: DataFrame, current: DataFrame, depth: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """(leaf) of the leaves that differ, and per level how many nodes were compared and how many of them differ.

    Level by level only children of unequal nodes are compared. Nodes stay distributed; a level is one join.
    """
    now = current.select("path", F.col("fingerprint").alias("_now"))
    both = materialise(
        pinned.select("path", F.col("fingerprint").alias("_then")).join(now, "path", "full")
        .select("path", F.length("path").alias("_level"), (~F.col("_then").eqNullSafe(F.col("_now"))).alias("_differs")),
        "tree-nodes",
    )
    looked, open_ = [], None
    for level in range(depth + 1):
        here = both.where(F.col("_level") == level)
        if open_ is not None:
            here = here.withColumn("_parent", F.substring("path", 1, level - 1)).join(open_, "_parent", "left_semi")
        here = materialise(here.select("path", "_differs"), "tree-level")
        compared, differ = here.agg(F.count(F.lit(1)), F.count(F.when(F.col("_differs"), 1))).first()
        looked.append((compared, differ))
        open_ = here.where("_differs").select(F.col("path").alias("_parent"))
        if not differ:
            break
    return open_.select(F.col("_parent").alias("leaf")), looked


def differing_keys(pinned: DataFrame, current: DataFrame, leaves: DataFrame) -> DataFrame:
    """(key, problem, n_pinned, n_now) of the keys in ``leaves`` whose rows are not the same.

    ``lost`` has no row left and ``added`` had none; ``doubled`` has all its rows and more of the same; ``changed`` is
    any other difference, such as a new value or fewer copies.
    """

    def side(marked: DataFrame, name: str) -> DataFrame:
        inside = marked.join(leaves, "leaf", "left_semi")
        zero = F.lit(0).cast("bigint")
        then, now = (F.col("copies"), zero) if name == "pinned" else (zero, F.col("copies"))
        return inside.select("leaf", "key", "row_hash", then.alias("_then"), now.alias("_now"))

    rows = side(pinned, "pinned").unionByName(side(current, "now"))
    rows = rows.groupBy("leaf", "key", "row_hash").agg(F.sum("_then").alias("_then"), F.sum("_now").alias("_now"))
    keys = rows.groupBy("leaf", "key").agg(
        F.sum("_then").alias("n_pinned"), F.sum("_now").alias("n_now"),
        F.max((F.col("_then") != F.col("_now")).cast("int")).alias("_differs"),
        F.min(((F.col("_now") >= F.col("_then")) & (F.col("_then") > 0)).cast("int")).alias("_more"),
    ).where("_differs = 1")
    problem = F.when(F.col("n_now") == 0, "lost").when(F.col("n_pinned") == 0, "added").when(F.col("_more") == 1, "doubled").otherwise("changed")
    return keys.select("key", problem.alias("problem"), "n_pinned", "n_now")
