"""Windows of a fixed width that occur more than once, found without comparing all windows or all pairs.

Shared by the two deduplicators, which differ in their units (words or bytes) and in which occurrence has to go.

1. *Anchors.* Every window owns its smallest seed (see ``fingerprints.anchors``), so only every 5th word or 100th byte
   becomes a row: (seed, context, key, place). ``context`` is the fingerprint of all that the anchor's windows cover.
2. *One sort.* The rows are range-partitioned and sorted by (seed, context, key). Rows with equal context share all
   their windows; a seed met once has no repeat and drops out. Only where one seed has several contexts do the windows
   have to be compared one by one (``open`` rows): the rims of repeated passages. The range partitioner cuts a seed or
   context held by a third of all rows into as many partitions as it needs, and each Arrow batch is judged by itself:
   what cannot be settled inside a batch is passed on as open, so no state and no group is ever held.
3. *Windows of open rows* are fingerprinted from the texts, sorted and judged in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm import fingerprints
from sensormill.llm.tables import KEY, compressed, unpack
from sensormill.workspace import materialise

Units = Callable[[bytes], np.ndarray]
ANCHORS = f"seed long, context long, {KEY} long, first long, windows int, offset int"
WINDOW = ["head", "tail", KEY, "first"]
SETTLED = f"{KEY} long, first long, windows int, offset int, open boolean"


#: Rows gathered before they leave a Python worker.
GATHERED = 200_000


def gathered(pieces: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Pieces of equal columns as batches of bounded size (or of one piece)."""
    held: list[tuple[np.ndarray, ...]] = []
    count = 0
    for piece in pieces:
        held.append(piece)
        count += len(piece[0])
        if count >= GATHERED:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names)
            held, count = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names)


def anchor_rows(rows: DataFrame, units: Units, width: int, seed: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from gathered(_anchors(batch), ["seed", "context", KEY, "first", "windows", "offset"])

    def _anchors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        for key, body in zip(batch[KEY].to_pylist(), batch["body"].to_pylist(), strict=True):
            for seeds, context, first, count, offset in fingerprints.anchors(units(body), width, seed):
                own = np.full(len(seeds), key)
                yield seeds.view(np.int64), context.view(np.int64), own, first, count.astype(np.int32), offset.astype(np.int32)

    return rows.select(KEY, "body").mapInArrow(cut, ANCHORS)


def settle(anchors: DataFrame, judge: Callable) -> DataFrame:
    """Sorted anchors judged batch by batch; ``judge`` says which rows go whole and which stay open."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            seed, context, key = (batch[c].to_numpy() for c in ("seed", "context", KEY))
            new_seed = np.concatenate([[True], seed[1:] != seed[:-1]])
            new_class = new_seed | np.concatenate([[True], context[1:] != context[:-1]])
            group, kind = np.cumsum(new_seed) - 1, np.cumsum(new_class) - 1
            many = np.bincount(group[new_class]) > 1
            many[[0, -1]] = True  # what stands in the next batch or partition is not known
            whole, undecided = judge(key, kind, np.flatnonzero(new_class), many[group])
            keep = np.flatnonzero(whole | undecided)
            if len(keep):
                taken = [batch[c].take(pa.array(keep)) for c in (KEY, "first", "windows", "offset")]
                flags = pa.array(undecided[keep] & ~whole[keep])
                yield pa.RecordBatch.from_arrays([*taken, flags], [KEY, "first", "windows", "offset", "open"])
                both = np.flatnonzero(whole & undecided)  # goes whole, and still stands for its class
                if len(both):
                    taken = [batch[c].take(pa.array(both)) for c in (KEY, "first", "windows", "offset")]
                    flags = pa.array(np.ones(len(both), dtype=bool))
                    yield pa.RecordBatch.from_arrays([*taken, flags], [KEY, "first", "windows", "offset", "open"])

    ordered = anchors.repartitionByRange("seed", "context", KEY).sortWithinPartitions("seed", "context", KEY)
    return materialise(ordered.mapInArrow(scan, SETTLED), "settled")


def open_windows(rows: DataFrame, settled: DataFrame, units: Units, width: int, span: int) -> DataFrame:
    """(head, tail, _row, first) for every window of the open rows.

    A window is named by two fingerprints of ``span`` units, at its begin and at its end, which together cover it.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from gathered(_windows(batch), WINDOW)

    def _windows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        for key, packed, firsts, counts in zip(*(batch[c].to_pylist() for c in (KEY, "packed", "firsts", "counts")), strict=True):
            names = fingerprints.windows(units(unpack(packed)), span).view(np.int64)
            counts = np.asarray(counts)
            runs = np.cumsum(counts) - counts
            starts = np.repeat(np.asarray(firsts) - runs, counts) + np.arange(counts.sum())
            yield names[starts], names[starts + width - span], np.full(len(starts), key), starts

    wanted = (
        settled.filter("open")
        .groupBy(KEY)
        .agg(F.collect_list(F.struct("first", "windows")).alias("w"))
        .select(KEY, F.col("w.first").alias("firsts"), F.col("w.windows").alias("counts"))
    )
    found = compressed(rows).join(wanted, KEY).select(KEY, "packed", "firsts", "counts")
    return found.mapInArrow(spell, f"head long, tail long, {KEY} long, first long")


def repeated_windows(found: DataFrame, decide: Callable, resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(_row, first) of the windows that have to go.

    The windows are sorted like the anchors and judged batch by batch. ``decide`` gives the rows that go for certain and
    those at a batch's rim, whose equals may stand in the next batch or partition: a few per batch, left to ``resolve``.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            head, tail, key = (batch[c].to_numpy() for c in WINDOW[:3])
            new = np.concatenate([[True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])])
            sure, rim = decide(key, np.cumsum(new) - 1, np.flatnonzero(new))
            for flags, certain in ((sure, True), (rim & ~sure, False), (rim & sure, False)):
                keep = pa.array(np.flatnonzero(flags))
                if len(keep):
                    columns = [batch[c].take(keep) for c in WINDOW]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(keep), certain))], [*WINDOW, "sure"])

    ordered = found.repartitionByRange(*WINDOW).sortWithinPartitions(*WINDOW)
    judged = materialise(ordered.mapInArrow(scan, f"head long, tail long, {KEY} long, first long, sure boolean"), "windows")
    return judged.filter("sure").select(KEY, "first").unionByName(resolve(judged.filter("NOT sure")).select(KEY, "first"))


def removal_spans(settled: DataFrame, repeated: DataFrame, width: int) -> DataFrame:
    """(_row, starts, ends): the removed stretches of each text, in units, overlapping as they come."""
    whole = settled.filter("NOT open").select(KEY, "first", (F.col("first") + F.col("windows") - 1 + width).alias("end"))
    single = repeated.select(KEY, "first", (F.col("first") + width).alias("end"))
    spans = whole.unionByName(single).groupBy(KEY).agg(F.collect_list(F.struct("first", "end")).alias("s"))
    return spans.select(KEY, F.col("s.first").alias("starts"), F.col("s.end").alias("ends"))


def covered(length: int, starts: list[int] | None, ends: list[int] | None) -> np.ndarray:
    """Mask of the units inside any span."""
    edges = np.zeros(length + 1, dtype=np.int64)
    if starts is not None and len(starts):
        np.add.at(edges, np.asarray(starts), 1)
        np.add.at(edges, np.asarray(ends), -1)
    return np.cumsum(edges[:-1]) > 0
