"""Benchmark decontamination with one FM-index per shard of training documents.

A shard is a run of documents of one task, bounded in bytes (a longer document is a shard of its own). Its words become
symbols of one sequence; words that no test phrase uses all become the same separator, which no phrase contains, so
stretches that cannot hold a phrase shrink to one symbol without changing any result. The index is searched backwards
for all phrases at once through the ranks of a wavelet tree, occurrences are located by sampled suffix positions, and
overlapping occurrences in a document merge into removal spans.

The phrases come in blocks of bounded size. Each block is carried by the tasks of one step in a chain of narrow steps,
so there is no shuffle and no cross join, whatever the number of phrases; a document passes all steps in one task.

Words: A-Z lower-cased, then runs of digits, letters a-z and anything beyond ASCII. A phrase is any ``width`` words in a
row of an item; an item of fewer words, but not none, is one phrase. NULL texts have no words; NULL item texts are no
items; NULL item ids count as the text ``NULL`` and items with the same id as one. Repeated documents are judged each by
itself. All columns of ``docs`` are kept by ``cut_spans``; ``find_spans`` returns doc_id and the figures.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm.fm_index import FMIndex

#: Bytes of test items that one step carries, and bytes of documents indexed together.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 4 << 20
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(body: bytes) -> list[bytes]:
    return body.translate(_FOLD).split()


def word_bounds(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of every word."""
    inside = np.frombuffer(body.translate(_FOLD), dtype=np.uint8) != 32
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


class Phrases:
    """The test phrases of one block of items, as rows of symbols from 2 (1 is any other word)."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.symbols: dict[bytes, int] = {}
        known: dict[tuple[int, ...], set[str]] = {}
        for item, body in items:
            symbols = [self.symbols.setdefault(w, len(self.symbols) + 2) for w in words_of(body)]
            for i in range(max(len(symbols) - width + 1, min(len(symbols), 1))):
                known.setdefault(tuple(symbols[i : i + width]), set()).add(item)
        self.items = [sorted(v) for v in known.values()]
        self.lengths = np.array([len(k) for k in known], dtype=np.int64)
        self.rows = np.full((len(known), width), -1, dtype=np.int64)
        for i, key in enumerate(known):
            self.rows[i, width - len(key) :] = key
        self.shortest = int(self.lengths.min()) if len(known) else 0

    def search(self, bodies: list[bytes]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Per document of a shard: word ranges of the occurrences and the items they come from."""
        out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in bodies]
        get, pieces, owner, begin = self.symbols.get, [], [], []
        for i, body in enumerate(bodies):
            symbols = np.array([get(w, 1) for w in words_of(body)], dtype=np.int64)
            edges = np.diff(np.concatenate([[0], (symbols > 1).astype(np.int8), [0]]))
            starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                if b - a >= self.shortest:
                    pieces += [symbols[a:b], np.ones(1, dtype=np.int64)]
                    owner.append(i)
                    begin.append(a)
        if not pieces or not len(self.rows):
            return out
        sizes = np.array([len(p) + 1 for p in pieces[::2]])
        piece_start = np.cumsum(sizes) - sizes
        index = FMIndex(np.concatenate(pieces))
        low, high = index.search(self.rows, self.lengths)
        hit = np.flatnonzero(high > low)
        phrase = np.repeat(hit, high[hit] - low[hit])
        rows = np.concatenate([np.arange(low[h], high[h]) for h in hit]) if len(hit) else np.zeros(0, dtype=np.int64)
        places = index.locate(rows)
        piece = np.searchsorted(piece_start, places, side="right") - 1
        for p, place, which in zip(phrase.tolist(), places.tolist(), piece.tolist(), strict=True):
            start = place - int(piece_start[which]) + begin[which]
            spans, items = out[owner[which]]
            spans.append((start, start + int(self.lengths[p])))
            items.update(self.items[p])
        return out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def blocks_of(items: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of bounded size, taken from the table one partition at a time."""
    texts = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("NULL")).alias("item"), F.col("text").cast("binary").alias("body")
    ).filter("body IS NOT NULL")
    block, size = [], 0
    for row in texts.toLocalIterator():
        if block and size + len(row.body) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row.item, bytes(row.body)))
        size += len(row.body)
    if block:
        yield block


def find(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` with ``_starts``, ``_ends`` (merged word ranges), ``_items`` (ids, as strings) and ``_words``."""
    marked = docs.withColumns({
        "_starts": F.lit(None).cast("array<int>"),
        "_ends": F.lit(None).cast("array<int>"),
        "_items": F.lit(None).cast("array<string>"),
    })
    for block in blocks_of(items):
        marked = _search_block(marked, block, width)
    return marked


def _search_block(marked: DataFrame, block: list[tuple[str, bytes]], width: int) -> DataFrame:
    carried = marked.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_BYTES, or one item

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(carried.value, width)
        for batch in batches:
            bodies = [(t or "").encode() for t in batch["text"].to_pylist()]
            found, shard, size = [], [], 0
            for body in bodies:
                if shard and size + len(body) > SHARD_BYTES:
                    found += phrases.search(shard)
                    shard, size = [], 0
                shard.append(body)
                size += len(body)
            found += phrases.search(shard) if shard else []
            before = zip(*(batch[c].to_pylist() for c in ("_starts", "_ends", "_items")), strict=True)
            spans, names = [], []
            for (new, ids), (starts, ends, old) in zip(found, before, strict=True):
                spans.append(merge([*zip(starts or [], ends or [], strict=True), *new]))
                names.append(sorted({*(old or []), *ids}))
            columns = {
                "_starts": pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int32())),
                "_ends": pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int32())),
                "_items": pa.array(names, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([columns.get(n, batch[n]) for n in batch.schema.names], batch.schema.names)

    return marked.mapInArrow(step, marked.schema)


def find_spans(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, starts, ends."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("text", "_starts", "_ends", "_items")]
            for text, starts, ends, names in zip(*columns, strict=True):
                hit = sum(ends or []) - sum(starts or [])
                digest = hashlib.sha256(",".join(names or []).encode()).hexdigest()
                out.append((len(words_of((text or "").encode())), hit, len(names or []), digest, hit > 0, starts or [], ends or []))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], names_out)

    names_out = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "starts", "ends"]
    found = find(docs.select("doc_id", "text"), items, width)
    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(
        finish,
        f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, starts array<int>, ends array<int>",
    )


def cut_spans(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The documents, all columns kept, with the words of every occurrence cut out of ``text``; ``n_chars`` follows it.

    Cut stretches run from the first byte of their first word to the last of their last one. Documents without any
    occurrence keep their text as it is, NULL included; one that only consisted of occurrences stays with what is left.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, starts, ends in zip(*(batch[c].to_pylist() for c in ("text", "_starts", "_ends")), strict=True):
                if starts:
                    body = text.encode()
                    first, past = word_bounds(body)
                    upto, kept = 0, []
                    for a, b in zip(starts, ends, strict=True):
                        kept.append(body[upto : first[a]])
                        upto = past[b - 1]
                    text = b"".join([*kept, body[upto:]]).decode("utf-8", "replace")
                texts.append(text)
            arrays = [pa.array(texts, pa.string()) if n == "text" else batch[n] for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    others = [F.col(c) for c in docs.columns if c != "text"]
    found = find(docs.select("text", F.struct(F.lit(0).alias("_"), *others).alias("_others")), items, width)
    cleaned = found.mapInArrow(cut, found.schema).select(*("text" if c == "text" else F.col("_others")[c].alias(c) for c in docs.columns))
    return recounted(cleaned)


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, as the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
