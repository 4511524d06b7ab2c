"""N-gram Jaccard self-join with Bayesian candidate pruning.

Two documents are linked if the Jaccard similarity of their sets of five-word shingles is ``THRESHOLD`` or more. Words
are runs of digits, letters (A-Z lower-cased) and anything beyond ASCII; a text of one to four words is one shingle.

1. Documents with equal sets are one class; only one of each class, its representative, goes on.
2. Representatives meet in buckets of MinHash bands (30 bands of 5 values: a pair at the threshold misses all of them
   with probability 7e-6). A bucket gives an edge from each member to its first one, not all pairs; the components of
   these edges are the clusters that can hold links.
3. Clusters are compared in cells: about ``CELL`` shingles of representatives of like size, so that a task holds two
   cells. A large cluster is cut by size class (sizes further apart than the threshold cannot be linked) and salt, and
   every pair of its cells is one task; small clusters share tasks.
4. Within a task, pairs are pruned in the Bayesian way: MinHash values are compared in steps of 16, and a pair is dropped
   as soon as the posterior probability that its similarity reaches the threshold, given its matches so far and a
   uniform prior, is below ``TOLERANCE``. What is left is verified exactly on the shingle sets.
5. Each task returns one row per document: its links, weighted by class sizes, and the smallest member it hangs together
   with; no pair is ever a row. Their components are the classes of linked documents.

NULL, empty and wordless texts have no links and are classes of their own. Repeated rows are documents linked to each
other. NULL or repeated ids are handled row by row. Other columns are ignored by ``linked`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm.components import components
from sensormill.llm.decontaminate import words_of
from sensormill.llm.fingerprints import mix, windows, word_units
from sensormill.llm.tables import KEY, compressed, keyed, unpack
from sensormill.workspace import materialise

WIDTH, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, BAND = 30, 5
STEP = 16
CELL = 500_000
#: What a document counts for at least, so that a cell of short texts stays small in number.
LEAST_LOAD = 400

_SEEDS = np.random.default_rng(6)
_XOR = _SEEDS.integers(0, 1 << 32, BANDS * BAND, dtype=np.uint64).astype(np.uint32)
_TIMES = _SEEDS.integers(0, 1 << 31, BANDS * BAND, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(body: bytes, width: int = WIDTH) -> np.ndarray:
    """The sorted different shingles of a text, as 64-bit fingerprints."""
    units = word_units(words_of(body))
    return np.unique(windows(units, min(width, len(units)))) if len(units) else units


def signature(own: np.ndarray) -> np.ndarray:
    """The MinHash values of a set."""
    small = (mix(own) >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_XOR), 0xFFFFFFFF, dtype=np.uint32)
    for begin in range(0, len(small), 1024):
        part = (small[begin : begin + 1024, None] ^ _XOR) * _TIMES
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(out, part.min(axis=0), out=out)
    return out


def least_matches(threshold: float, tolerance: float, steps: range) -> list[int]:
    """Per number of values compared, the fewest matches with which a pair is still worth a look.

    With a uniform prior the posterior of similarity s after m matches of k is Beta(m + 1, k - m + 1), and
    P(s >= t) = P(Binomial(k + 1, t) <= m).
    """
    out = []
    for k in steps:
        total, m = 0.0, -1
        while total < tolerance and m <= k:
            m += 1
            total += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out.append(m)
    return out


def candidate_pairs(left: np.ndarray, right: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature tables (or within one) that survive the pruning."""
    steps = range(STEP, left.shape[1] + 1, STEP)
    least = least_matches(threshold, TOLERANCE, steps)
    other = left if right is None else right
    found_a, found_b = [], []
    rows = max(1, 2_000_000 // max(len(other), 1))
    for begin in range(0, len(left), rows):
        part = left[begin : begin + rows]
        matches = np.zeros((len(part), len(other)), dtype=np.uint8)
        for v in range(STEP):
            matches += part[:, v, None] == other[None, :, v]
        alive = matches >= least[0]
        if right is None:
            alive &= np.arange(len(other))[None, :] > (begin + np.arange(len(part)))[:, None]
        a, b = np.nonzero(alive)
        count = matches[a, b].astype(np.int64)
        for upto, fewest in zip(steps[1:], least[1:], strict=True):
            if not len(a):
                break
            for v in range(upto - STEP, upto):
                count += part[a, v] == other[b, v]
            keep = count >= fewest
            a, b, count = a[keep], b[keep], count[keep]
        found_a.append(a + begin)
        found_b.append(b)
    return np.concatenate(found_a) if found_a else np.zeros(0, int), np.concatenate(found_b) if found_b else np.zeros(0, int)


def verified(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, exactly."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if len(a) <= 8 * len(sets):
        common = np.array([_common(sets[i], sets[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)], dtype=np.int64)
    else:  # many pairs of few sets: count common members by products of 0/1 blocks
        common = _products(sets, a, b)
    return common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9


def _common(one: np.ndarray, two: np.ndarray) -> int:
    both = np.concatenate([one, two])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _products(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    rows, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    first, second = place[: len(a)], place[len(a) :]
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    members, column = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
    shared = np.bincount(column, minlength=len(members)) > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(rows), len(rows)), dtype=np.float32)
    width = max(64, 4_000_000 // max(len(rows), 1))
    for begin in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [begin, begin + width])
        block = np.zeros((len(rows), min(width, int(shared.sum()) - begin)), dtype=np.float32)
        block[owner[lo:hi], column[lo:hi] - begin] = 1.0
        total += block @ block.T
    return np.rint(total[first, second]).astype(np.int64)


def hang_together(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each index is connected with."""
    root = np.arange(count)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def compare(
    rows: list[tuple[int, int, int, bytes]], side: list[int], threshold: float, itself: bool
) -> list[tuple[int, int, int]]:
    """(key, links, key of the smallest member it hangs together with) for the (key, copies, _, packed) of one task.

    With ``itself`` a cell meets itself. Else ``side`` is 0 and 1 for the two cells of a pair; one of them may hold no
    rows, and then there is nothing to compare: links inside a cell are counted only where it meets itself.
    """
    if not itself and len(set(side)) < 2:
        return []
    sets = [shingles(unpack(r[3])) for r in rows]
    table = np.array([signature(s) for s in sets])
    sides = np.array(side)
    if not itself:
        one, two = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        a, b = candidate_pairs(table[one], table[two], threshold)
        a, b = one[a], two[b]
    else:
        a, b = candidate_pairs(table, None, threshold)
    if len(a):
        good = verified(sets, a, b, threshold)
        a, b = a[good], b[good]
    copies = np.array([r[1] for r in rows], dtype=np.int64)
    links = np.zeros(len(rows), dtype=np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    keys = np.array([r[0] for r in rows], dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    at = np.empty_like(order)
    at[order] = np.arange(len(order))
    root = keys[order][hang_together(len(rows), at[a], at[b])[at]]
    return [(int(k), int(n), int(r)) for k, n, r in zip(keys, links, root, strict=True) if n]


def _described(rows: DataFrame) -> DataFrame:
    """(_row, set_a, set_b, size, bands): the set's name at twice 64 bits, its size, and its bands."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            out: list[tuple] = []
            for body in batch["body"].to_pylist():
                own = shingles(body)
                if not len(own):
                    out.append((0, 0, 0, []))
                    continue
                values = signature(own).astype(np.uint64).reshape(BANDS, BAND)
                name = mark
                for v in range(BAND):
                    name = mix(name + values[:, v])
                whole = mix(own).sum(dtype=np.uint64), mix(own + np.uint64(1)).sum(dtype=np.uint64)
                out.append((*np.array(whole).view(np.int64).tolist(), len(own), name.view(np.int64).tolist()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else []
            if arrays:
                yield pa.RecordBatch.from_arrays([batch[KEY], *arrays], [KEY, "set_a", "set_b", "size", "bands"])

    return rows.select(KEY, "body").mapInArrow(describe, f"{KEY} long, set_a long, set_b long, size long, bands array<long>")


def _clusters(classes: DataFrame) -> DataFrame:
    """(_row, cluster) of the representatives that share a bucket with another one."""
    bands = classes.select(KEY, F.explode("bands").alias("bucket"))
    first = bands.groupBy("bucket").agg(F.min(KEY).alias("lead"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = bands.join(first, "bucket").select(F.col(KEY).alias("a"), F.col("lead").alias("b"))
    return components(edges).select(F.col("node").alias(KEY), F.col("root").alias("cluster"))


def _tasks(members: DataFrame, threshold: float) -> DataFrame:
    """(task, part, side, itself, _row, copies): which representatives each task compares.

    ``part`` keeps small clusters apart, ``itself`` says that a cell meets itself and not another one.
    """
    sized = members.withColumns({
        "step": F.floor(F.log("size") / F.lit(-float(np.log(threshold)))).cast("int"),
        "load": F.greatest("size", F.lit(LEAST_LOAD)),
    })
    totals = materialise(sized.groupBy("cluster").agg(F.sum("load").alias("total")), "clusters")
    small_sum = totals.filter(F.col("total") <= CELL).agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    slots = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-small_sum // CELL))
    known = sized.join(totals, "cluster")
    small = known.filter(F.col("total") <= CELL).select(
        F.concat_ws(":", F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(slots))).alias("task"),
        F.col("cluster").alias("part"), F.lit(0).alias("side"), F.lit(True).alias("itself"), KEY, "copies",
    )
    large = known.filter(F.col("total") > CELL)
    cells = large.groupBy("cluster", "step").agg(F.ceil(F.sum("load") / F.lit(CELL)).cast("int").alias("salts"))
    near = cells.select("cluster", F.explode(F.array(*(F.col("step") + d for d in (-1, 0, 1)))).alias("step"), F.col("step").alias("other"), F.col("salts").alias("others"))
    salted = large.join(cells, ["cluster", "step"]).withColumn("salt", F.pmod(F.xxhash64(KEY), F.col("salts")).cast("int"))
    met = salted.join(near, ["cluster", "step"]).withColumn("other_salt", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    own, other = F.struct("step", "salt"), F.struct(F.col("other").alias("step"), F.col("other_salt").alias("salt"))
    pairs = met.select(
        F.concat_ws(":", "cluster", *(F.least(own, other)[c] for c in ("step", "salt")), *(F.greatest(own, other)[c] for c in ("step", "salt"))).alias("task"),
        F.lit(0).cast("bigint").alias("part"), (own > other).cast("int").alias("side"), (own == other).alias("itself"), KEY, "copies",
    )
    return small.unionByName(pairs)


def linked(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), n_links, and its key ``_row``."""
    rows = keyed(docs)
    described = materialise(_described(rows), "described")
    filled = described.filter("size > 0")
    classes = filled.groupBy("set_a", "set_b", "size").agg(F.min(KEY).alias(KEY), F.count("*").alias("copies"))
    leads = materialise(described.select(KEY, "bands").join(classes, KEY), "classes")
    members = leads.select(KEY, "size", "copies").join(_clusters(leads), KEY)
    dealt = materialise(_tasks(materialise(members, "members"), threshold), "tasks")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby("part", sort=False):
            fields = (part[c].tolist() for c in (KEY, "copies", "part", "packed"))
            out += compare(list(zip(*fields, strict=True)), part["side"].tolist(), threshold, bool(part["itself"].iloc[0]))
        return pd.DataFrame(out, columns=[KEY, "links", "root"])

    # A merge at every size: whether the members are few enough to broadcast must not change what is shuffled.
    compared = compressed(rows).join(dealt.hint("merge"), KEY).groupBy("task").applyInPandas(run, f"{KEY} long, links long, root long")
    found = materialise(compared, "links")
    links = found.groupBy(KEY).agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col(KEY).alias("a"), F.col("root").alias("b")))
    leads = leads.join(links, KEY, "left").join(groups.withColumnRenamed("node", KEY), KEY, "left")
    each = leads.select(
        "set_a", "set_b", "size",
        F.coalesce("root", KEY).alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    placed = filled.select(KEY, "set_a", "set_b", "size").join(each, ["set_a", "set_b", "size"]).select(KEY, "root", "n_links")
    alone = described.filter("size = 0").select(KEY, F.col(KEY).alias("root"), F.lit(0).cast("bigint").alias("n_links"))
    every = materialise(placed.unionByName(alone), "placed")
    ids = rows.select(KEY, "doc_id")
    names = ids.select(F.col(KEY).alias("root"), F.col("doc_id").alias("class_id"))
    return every.join(ids, KEY).join(names, "root").select("doc_id", "class_id", "n_links", KEY, "root")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with one, that of the smallest id, of every class of linked ones; all columns are kept.

    Without unique ids, rows are numbered first and the smallest number of the class stays.
    """
    ids = docs.groupBy("doc_id").count()
    if ids.filter("count > 1 OR doc_id IS NULL").isEmpty():
        kept = linked(docs, threshold).filter(F.col(KEY) == F.col("root")).select("doc_id")
        return docs.join(kept, "doc_id", "left_semi")
    others = F.struct(*(F.col(c) for c in docs.columns))
    numbered = materialise(docs.select(F.monotonically_increasing_id().alias("doc_id"), "text", others.alias("_others")), "numbered")
    kept = linked(numbered, threshold).filter(F.col(KEY) == F.col("root")).select("doc_id")
    return numbered.join(kept, "doc_id", "left_semi").select("_others.*")
