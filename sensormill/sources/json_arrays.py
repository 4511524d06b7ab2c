"""JSON arrays of any size in many tasks: byte ranges that find the borders of elements by themselves.

A range of a JSON text cannot know whether it begins inside a string. So every range is scanned for each state it may
begin in: outside a string, inside one, or inside one behind a backslash. What it does to the state and to the depth of
brackets is a few numbers; composing them in order gives every range its true beginning. Then a range cuts out the
elements whose leading bracket or comma it holds and reads on behind its end until the last of them is complete.

A file is read twice, in parallel. Bytes are looked at in blocks with numpy, so what is held is a block and an element.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormill.sources.paths import locate
from sensormill.streaming.replay import parse_envelopes
from sensormill.workspace import materialise, spread

SPLIT = 64 << 20
BLOCK = 4 << 20
#: What is read at first behind the end of a range, where mostly little is missing; each further block is twice as long.
TAIL = 4 << 10
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2

_QUOTE, _BACKSLASH, _COMMA = 34, 92, 44
_OPEN, _CLOSE = (91, 123), (93, 125)
#: Bytes that can change the state or the depth, or border an element.
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[_QUOTE, _COMMA, *_OPEN, *_CLOSE]] = True


class Scan:
    """Runs over bytes block by block. State is one of the three; depth counts open brackets."""

    def __init__(self, state: int, depth: int = 0):
        self.state, self.depth = state, depth

    def block(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of brackets and commas outside strings, the depth behind each, and their bytes."""
        content = np.frombuffer(data, dtype=np.uint8)
        if not len(content):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), content
        at = np.flatnonzero(_MARKS[content])
        marks = content[at]
        quotes = marks == _QUOTE
        slashes = np.flatnonzero(content == _BACKSLASH)
        dangling = False
        if self.state == ESCAPED:
            quotes[at == 0] = False
            slashes = slashes[slashes != 0]
        if len(slashes):
            # Of each run of backslashes every other one is escaped, and what follows a run of odd length.
            first = np.flatnonzero(np.r_[True, np.diff(slashes) != 1])
            length = np.diff(np.r_[first, len(slashes)])
            odd = (slashes[first] + length)[length % 2 == 1]
            dangling = bool(len(odd)) and odd[-1] == len(content)
            quotes &= ~np.isin(at, odd)
        inside = (np.cumsum(quotes) + (self.state != OUTSIDE)) % 2 == 1
        opens = np.isin(marks, _OPEN) & ~inside
        closes = np.isin(marks, _CLOSE) & ~inside
        depth = self.depth + np.cumsum(opens.astype(np.int64) - closes.astype(np.int64))
        ends_inside = bool(inside[-1]) if len(at) else self.state != OUTSIDE
        self.state = (ESCAPED if dangling else INSIDE) if ends_inside else OUTSIDE
        self.depth = int(depth[-1]) if len(at) else self.depth
        borders = opens | closes | ((marks == _COMMA) & ~inside)
        return at[borders], depth[borders], marks[borders]


def _blocks(path: str, begin: int, end: int, border: int | None = None) -> Iterator[tuple[int, bytes]]:
    """The bytes block by block. One ends at ``border``, and those behind it are short at first."""
    system, name, _ = locate(path)
    border, step = end if border is None else border, TAIL
    with system.open_input_file(name) as file:
        at = begin
        while at < end:
            if at < border:
                size = min(BLOCK, border - at)
            else:
                size, step = min(BLOCK, step, end - at), step * 2
            data = file.read_at(size, at)
            if not data:
                return
            yield at, data
            at += len(data)


def _effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        states, deltas = [], []
        for path, begin, end in zip(batch["path"], batch["begin"], batch["end"], strict=True):
            scans = [Scan(s) for s in (OUTSIDE, INSIDE, ESCAPED)]
            for _, data in _blocks(path, begin, end):
                for scan in scans:
                    scan.block(data)
            states.append([s.state for s in scans])
            deltas.append([s.depth for s in scans])
        yield batch.assign(states=states, deltas=deltas)


def _compose(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state and depth every range of a file begins in; a few numbers per range."""
    ranges = ranges.sort_values("begin")
    state, depth, states, depths = OUTSIDE, 0, [], []
    for after, delta in zip(ranges["states"], ranges["deltas"], strict=True):
        states.append(state)
        depths.append(depth)
        state, depth = int(after[state]), depth + int(delta[state])
    return ranges.assign(state=states, depth=depths)[["path", "begin", "end", "byte_size", "state", "depth"]]


def elements_of(path: str, begin: int, end: int, byte_size: int, state: int, depth: int) -> Iterator[bytes]:
    """The elements of the array whose leading bracket or comma lies in the range."""
    scan = Scan(state, depth)
    held: list[bytes] | None = None  # what is known of the current element
    for at, data in _blocks(path, begin, byte_size, end):
        places, depths, marks = scan.block(data)
        borders = ((marks == _COMMA) & (depths == 1)) | (np.isin(marks, _OPEN) & (depths == 1)) | (np.isin(marks, _CLOSE) & (depths == 0))
        last = 0
        for place, mark in zip(places[borders].tolist(), marks[borders].tolist(), strict=True):
            if mark in _OPEN:
                if mark != _OPEN[0]:
                    raise ValueError(f"{path} holds no JSON array")
            elif held is not None:
                held.append(data[last:place])
                whole = b"".join(held).strip()
                if whole:
                    yield whole
            if at + place >= end or mark in _CLOSE:
                return
            held, last = [], place + 1
        if held is None and at + len(data) >= end:
            return
        if held is not None:
            held.append(data[last:])
    if held is not None:
        raise ValueError(f"{path} ends inside its array")


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            part, size = [], 0
            for element in elements_of(row.path, row.begin, row.end, row.byte_size, row.state, row.depth):
                part.append(element.decode())
                size += len(element)
                if size >= BLOCK:
                    yield pd.DataFrame({"path": row.path, "element": part})
                    part, size = [], 0
            if part:
                yield pd.DataFrame({"path": row.path, "element": part})


def json_elements(files: DataFrame, split: int = SPLIT) -> DataFrame:
    """(path, element) of JSON array files (path, byte_size): the text of every element, cut out in many tasks."""
    steps = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("byte_size") - 1, F.lit(0)), F.lit(split).cast("bigint"))
    ranges = files.where("byte_size > 0").select("path", "byte_size", F.explode(steps).alias("begin"))
    ranges = ranges.withColumn("end", F.least(F.col("begin") + split, F.col("byte_size")))
    columns = "path string, byte_size bigint, begin bigint, `end` bigint"
    dealt = ranges.withColumn("_task", F.concat_ws(":", "path", "begin"))
    seen = spread(dealt, "_task").drop("_task").mapInPandas(_effects, f"{columns}, states array<int>, deltas array<bigint>")
    placed = seen.groupBy("path").applyInPandas(_compose, "path string, begin bigint, `end` bigint, byte_size bigint, state int, depth bigint")
    placed = materialise(placed.withColumn("_task", F.concat_ws(":", "path", "begin")), "json-ranges")
    return spread(placed, "_task").drop("_task").mapInPandas(_cut, "path string, element string")


def array_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, byte_size) of a JSON array file, or of all files of a folder of such."""
    from sensormill.sources.files import list_files

    system, name, _ = locate(path)
    info = system.get_file_info(name)
    if info.is_file:
        return spark.range(1).select(F.lit(path).alias("path"), F.lit(info.size).cast("bigint").alias("byte_size"))
    folder = spark.range(1).select(F.lit("json").alias("log_id"), F.lit(path).alias("root"))
    return list_files(folder, levels=0).select("path", "byte_size")


def read_array(spark: SparkSession, path: str, ddl: str, split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(rows, dead letters with path, raw text and reason) of the elements, in the fields of ``ddl``."""
    return parse_envelopes(json_elements(array_files(spark, path), split), "element", ddl)
