"""Near copies among vectors: all pairs with a cosine of ``threshold`` or more, by PCA-ordered tiled comparison.

1. Equal vectors are one: only distinct ones are compared, with their number of copies.
2. Unit vectors are turned into their principal axes. The second-moment matrix is summed over all rows in Spark; only
   that matrix, of the size of a vector squared, reaches the driver, and its axes go to the tasks. So vectors should have
   no more than a few thousand components (2,000 make a matrix of 32 MB).
3. Linked unit vectors are no further apart than ``sqrt(2 - 2 * threshold)``, in each coordinate too. A grid of that width
   over the first three axes makes cells; only a cell and its neighbours can be linked. Cells are dealt into tiles of
   bounded bytes, and pairs of tiles whose boxes in the leading axes lie further apart are dropped.
4. A pair of tiles is compared in a task. Products of the leading axes come first. What the others can still add is at most
   the product of the two suffix norms; once that cannot reach the threshold for a pair it is given up. While many pairs
   are open, products are dense, then pair by pair. Pairs within rounding of the threshold are decided by exactly rounded
   sums over the given vectors.
5. A task returns, per vector, its links and the smallest vector it hangs together with, so a group of near copies gives
   rows in proportion to its vectors. Components of these are found by hooking and pointer jumping.

NULL, empty and zero vectors and such with NULL or non-finite components link with nothing and are kept. Vectors of
different lengths are not linked. Repeated rows are vectors linked to each other. NULL or repeated ids are handled row by
row. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm.components import components
from sensormill.llm.tables import KEY
from sensormill.llm.tiles import brought_together, dealt, gathered, meetings
from sensormill.workspace import materialise

THRESHOLD = 0.95
#: Bytes of vectors that a tile holds at most (about), at 8 bytes a component.
TILE_BYTES = 1 << 22
#: Axes that make the grid, and axes of the boxes.
GRID, BOX = 3, 8
#: Axes of the first product; each further step doubles what is known.
FIRST = 16
#: Rows of a tile whose products are held at once.
ROWS = 512
#: Sums of products may be off by this; closer to the threshold a pair is summed exactly.
ROUNDING = 1e-9
CELL = ["width", *(f"cell_{i}" for i in range(GRID))]
#: A cell and half of its neighbours: each pair of cells is looked at once.
NEIGHBOURS = [(0, *move) for move in product((-1, 0, 1), repeat=GRID) if move >= (0,) * GRID]


def _keyed(vectors: DataFrame) -> DataFrame:
    """(_row, vec_id, embedding); rows are numbered in order of id where ids are repeated or NULL."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    if rows.groupBy("vec_id").count().filter("count > 1 OR vec_id IS NULL").isEmpty():
        return rows.select(F.col("vec_id").alias(KEY), "vec_id", "embedding")
    ordered = rows.orderBy(F.col("vec_id").asc_nulls_last()).withColumn(KEY, F.monotonically_increasing_id())
    return materialise(ordered.select(KEY, "vec_id", "embedding"), "numbered-vectors")


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that no square runs over or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(lists: pa.Array) -> np.ndarray:
    """The vectors of a list array, all of one length."""
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(lists), -1)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per length of vectors the axes as columns, those of most energy first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            widths = batch["width"].to_numpy()
            for width in np.unique(widths).tolist():
                own = units(_matrix(batch["embedding"].filter(pa.array(widths == width))))
                sums[width] = sums.get(width, 0) + own.T @ own
        for width, total in sums.items():
            columns = [pa.array([width] * width, pa.int64()), pa.array(range(width), pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["width", "line", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"width": pdf["width"].iloc[:1], "line": pdf["line"].iloc[:1], "sums": [np.sum(pdf["sums"].tolist(), axis=0).tolist()]})

    schema = "width long, line long, sums array<double>"
    parts = vectors.select("width", "embedding").mapInArrow(moments, schema)
    lines = sorted(parts.groupBy("width", "line").applyInPandas(add, schema).collect())
    axes = {}
    for width in {row.width for row in lines}:
        _, found = np.linalg.eigh(np.array([row.sums for row in lines if row.width == width]))
        axes[width] = np.ascontiguousarray(found[:, ::-1])
    return axes


def _placed(vectors: DataFrame, axes: dict[int, np.ndarray], reach: float) -> DataFrame:
    """The vectors with their cell, their leading coordinates and the norm of the others."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch["width"].to_numpy()
            lead = np.zeros((batch.num_rows, BOX))
            rest = np.zeros(batch.num_rows)
            for width in np.unique(widths).tolist():
                rows = widths == width
                turned = units(_matrix(batch["embedding"].filter(pa.array(rows)))) @ axes[width]
                known = min(BOX, width)
                lead[rows, :known] = turned[:, :known]
                rest[rows] = np.sqrt((turned[:, known:] ** 2).sum(axis=1))
            cells = np.floor(lead[:, :GRID] / (reach * (1 + 1e-6))).astype(np.int64)
            columns = [*batch.columns, *(pa.array(cells[:, i]) for i in range(GRID)), pa.array(list(lead)), pa.array(rest)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *CELL[1:], "lead", "rest"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    cells = ", ".join(f"{c} long" for c in CELL[1:])
    return vectors.mapInArrow(place, f"{kept}, {cells}, lead array<double>, rest double")


class Vectors:
    """The vectors of one tile: as given, and as unit vectors in the principal axes with their suffix norms."""

    def __init__(self, keys: np.ndarray, copies: np.ndarray, given: np.ndarray, axes: np.ndarray):
        self.keys, self.copies, self.given = keys, copies, given
        self.turned = units(given) @ axes
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]
        self.suffix = np.sqrt(np.concatenate([squares, np.zeros((len(given), 1))], axis=1))


def _steps(width: int) -> list[int]:
    upto, steps = FIRST, [0]
    while upto < width:
        steps.append(upto)
        upto *= 2
    return [*steps, width]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    scale_a, scale_b = np.abs(a).max(), np.abs(b).max()
    a, b = a / scale_a, b / scale_b
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def linked_pairs(one: Vectors, two: Vectors, threshold: float, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked vectors, a few rows of ``one`` at a time."""
    steps = _steps(one.turned.shape[1])
    least = threshold - ROUNDING
    for begin in range(0, len(one.turned), ROWS):
        rows = slice(begin, min(begin + ROWS, len(one.turned)))
        left, left_suffix = one.turned[rows], one.suffix[rows]
        known = np.zeros((len(left), len(two.turned)))
        a = b = value = None
        for low, high in zip(steps[:-1], steps[1:], strict=True):
            if a is None:
                known += left[:, low:high] @ two.turned[:, low:high].T
                open_ = known + left_suffix[:, high, None] * two.suffix[None, :, high] >= least
                if itself:
                    open_ &= np.arange(len(two.turned))[None, :] > (begin + np.arange(len(left)))[:, None]
                if np.count_nonzero(open_) * 16 <= open_.size or high == steps[-1]:
                    a, b = np.nonzero(open_)
                    value = known[a, b]
                continue
            value = value + _by_pair(left[:, low:high], two.turned[:, low:high], a, b)
            still = value + left_suffix[a, high] * two.suffix[b, high] >= least
            a, b, value = a[still], b[still], value[still]
        a = a + begin
        good = value >= threshold
        for i in np.flatnonzero(np.abs(value - threshold) <= ROUNDING).tolist():
            good[i] = exact_cosine(one.given[a[i]], two.given[b[i]]) >= threshold
        yield a[good], b[good]


def _by_pair(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    chunk = max(1, (1 << 20) // left.shape[1])
    for begin in range(0, len(a), chunk):
        part = slice(begin, begin + chunk)
        out[part] = np.einsum("ij,ij->i", left[a[part]], right[b[part]])
    return out


def hook(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (the smallest index of each component) after the pairs have been joined to those in ``root``."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if len(a):
            root = root.copy()
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                further = root[root]
                if np.array_equal(further, root):
                    break
                root = further
    return root


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def tile(members: pa.Array, row: int) -> Vectors:
        content = members[row].values
        given = _matrix(content.field("embedding"))
        keys, copies = (content.field(c).to_numpy(zero_copy_only=False) for c in (KEY, "copies"))
        order = np.argsort(keys)
        return Vectors(keys[order], copies[order], given[order], axes[given.shape[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = tile(batch["members_a"], row)
                itself = batch["tile_a"][row] == batch["tile_b"][row]
                two = one if itself else tile(batch["members_b"], row)
                shift = 0 if itself else len(one.keys)
                keys = one.keys if itself else np.concatenate([one.keys, two.keys])
                links = np.zeros(len(keys))
                # Smaller keys must have smaller indices, so that a root is the smallest key.
                rank = np.empty(len(keys), dtype=np.int64)
                rank[np.argsort(keys)] = np.arange(len(keys))
                root = np.arange(len(keys))
                for a, b in linked_pairs(one, two, threshold, itself):
                    links += np.bincount(a, two.copies[b], len(keys)) + np.bincount(b + shift, one.copies[a], len(keys))
                    root = hook(root, rank[a], rank[b + shift])
                found = np.flatnonzero(links)
                columns = [pa.array(keys[found]), pa.array(np.rint(links[found]).astype(np.int64)), pa.array(np.sort(keys)[root[rank[found]]])]
                yield pa.RecordBatch.from_arrays(columns, [KEY, "links", "root"])

    return run


def near_copies(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (the smallest id reachable), kept, and its key ``_row``."""
    reach = math.sqrt(2 - 2 * threshold)
    rows = _keyed(vectors)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    good = rows.filter(F.coalesce(usable, F.lit(False)))
    distinct = good.groupBy("embedding").agg(F.min(KEY).alias(KEY), F.count("*").alias("copies"))
    distinct = materialise(distinct.withColumn("width", F.size("embedding").cast("long")), "distinct-vectors")
    axes = principal_axes(distinct)
    placed = materialise(_placed(distinct, axes, reach), "placed-vectors")
    room = F.greatest(F.lit(1), F.floor(F.lit(TILE_BYTES // 8) / F.col("width")))
    boxes = [f(F.get("lead", F.lit(i))).alias(f"{name}_{i}") for i in range(BOX) for name, f in (("low", F.min), ("high", F.max))]
    boxes += [F.min("rest").alias(f"low_{BOX}"), F.max("rest").alias(f"high_{BOX}")]
    tiles = materialise(gathered(dealt(placed, CELL, KEY, room), CELL, F.struct(KEY, "copies", "embedding"), *boxes), "vector-tiles")
    sides = [f"{name}_{i}" for i in range(BOX + 1) for name in ("low", "high")]
    gaps = F.lit(0.0)
    for i in range(BOX + 1):
        gap = F.greatest(F.lit(0.0), F.col(f"low_{i}_a") - F.col(f"high_{i}_b"), F.col(f"low_{i}_b") - F.col(f"high_{i}_a"))
        gaps = gaps + gap * gap
    pairs = meetings(tiles, CELL, NEIGHBOURS, sides).filter(gaps <= reach * reach + ROUNDING)
    compared = brought_together(pairs, tiles, "vector-tile-pairs").mapInArrow(_compare(axes, threshold), f"{KEY} long, links long, root long")
    found = materialise(compared, "vector-links")
    links = found.groupBy(KEY).agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col(KEY).alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", KEY)
    each = distinct.join(links, KEY, "left").join(roots, KEY, "left").select(
        "embedding", F.coalesce("root", KEY).alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    linked = good.join(each, "embedding").select(KEY, "vec_id", "n_links", "root")
    alone = rows.filter(~F.coalesce(usable, F.lit(False))).select(KEY, "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col(KEY).alias("root"))
    every = materialise(linked.unionByName(alone), "vectors")
    names = every.filter(F.col(KEY) == F.col("root")).select("root", F.col("vec_id").alias("component_id"))
    return every.join(names, "root").select("vec_id", "n_links", "component_id", (F.col(KEY) == F.col("root")).alias("kept"), KEY)
