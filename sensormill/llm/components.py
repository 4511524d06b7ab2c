"""Connected components of an edge table, by repeated hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.workspace import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): the root is the smallest node of the component.

    Every round replaces the edges by those between present roots, so the edge table shrinks; each round's tables are
    written to the shared folder. All steps are aggregations and joins by node; no component is ever gathered.
    """
    edges = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    while True:
        labels = _jump(labels)
        left = labels.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = labels.select(F.col("node").alias("b"), F.col("root").alias("y"))
        between = edges.join(left, "a").join(right, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = materialise(between.distinct(), "edges")
        if edges.isEmpty():
            return labels
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.least("a", F.min("b")).alias("next")).withColumnRenamed("a", "root")
        moved = labels.join(hooks, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        roots = hooks.select(F.col("root").alias("node"), F.col("next").alias("root"))
        labels = materialise(moved.unionByName(roots).groupBy("node").agg(F.min("root").alias("root")), "roots")


def _jump(labels: DataFrame) -> DataFrame:
    """Follow the pointers until every node points to a root that points to itself."""
    while True:
        up = labels.filter("node <> root").select(F.col("node").alias("root"), F.col("root").alias("higher"))
        if labels.join(up, "root", "left_semi").isEmpty():
            return labels
        moved = labels.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
        labels = materialise(moved, "roots")
