"""Substring deduplication over words: seed and extend.

Seeds are winnowed anchors of four words. Documents meet on equal seeds; each meeting is extended to the left and to
the right as far as the texts agree, and what reaches the threshold length is a repeat. Extension happens by content:
an anchor whose whole surroundings agree with those of an earlier document is settled at once, the others are extended
window by window, every window being the seed with so many words on the left and the rest on the right. Overlapping
windows of one document merge into maximal repeats.

A word goes if a window of ``width`` words over it also starts in a document with a smaller id. NULL ids come last and
rows with the same id, NULL included, do not remove each other's words. NULL, empty and shorter texts lose nothing and
are returned with their figures; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm import repeats
from sensormill.llm.fingerprints import word_units
from sensormill.llm.tables import KEY, compressed, keyed, unpack

SEED_WORDS = 4
RESULT = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string, kept string"


def units(body: bytes) -> np.ndarray:
    return word_units(body.split())  # bytes.split() cuts at ASCII white space only


def _judge(key: np.ndarray, kind: np.ndarray, leaders: np.ndarray, many: np.ndarray):
    """Rows of a later document go whole; the first document of a class stands for it where the seed has more classes."""
    own = key == key[leaders][kind]
    return ~own, own & many


def _decide(key: np.ndarray, kind: np.ndarray, leaders: np.ndarray):
    """Windows go where the same window of an earlier document stands before them in the batch."""
    own = key == key[leaders][kind]
    rim = own & (kind == 0)
    rim[leaders[-1]] = True
    return ~own, rim


def _later(rim: DataFrame) -> DataFrame:
    earliest = rim.groupBy("head", "tail").agg(F.min(KEY).alias("earliest"))
    return rim.join(earliest, ["head", "tail"]).filter(F.col(KEY) > F.col("earliest"))


def _judge_nothing(key: np.ndarray, kind: np.ndarray, leaders: np.ndarray, many: np.ndarray):
    """Every anchor whose seed is met twice stays open."""
    return np.zeros(len(key), dtype=bool), many | (np.bincount(kind)[kind] > 1)


def repeated_spans(rows: DataFrame, width: int) -> DataFrame:
    settled = repeats.settle(repeats.anchor_rows(rows, units, width, min(SEED_WORDS, width)), _judge)
    found = repeats.open_windows(rows, settled, units, width, -(-width // 2))
    return repeats.removal_spans(settled, repeats.repeated_windows(found, _decide, _later), width)


def remove_repeats(docs: DataFrame, width: int = 13, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, n_spans, kept_sha256 and, if asked for, the kept text."""
    rows = keyed(docs)
    if rows.filter(f"doc_id IS NULL OR doc_id <> {KEY}").isEmpty():
        return _apply(rows, repeated_spans(rows, width), with_text)
    return _apply(rows, spans_by_id(rows, width), with_text)


def spans_by_id(rows: DataFrame, width: int) -> DataFrame:
    """The same where ids repeat or are missing: every window is compared by the first row number of its id."""
    first = rows.groupBy("doc_id").agg(F.min(KEY).alias("id_row"))
    rank = rows.join(first, rows.doc_id.eqNullSafe(first.doc_id)).select(KEY, "id_row")
    anchors = repeats.anchor_rows(rows, units, width, min(SEED_WORDS, width))
    settled = repeats.settle(anchors, _judge_nothing)
    found = repeats.open_windows(rows, settled, units, width, -(-width // 2)).join(rank, KEY)
    earliest = found.groupBy("head", "tail").agg(F.min("id_row").alias("earliest"))
    later = found.join(earliest, ["head", "tail"]).filter(F.col("id_row") > F.col("earliest"))
    return repeats.removal_spans(settled, later, width)


def _apply(rows: DataFrame, spans: DataFrame, with_text: bool) -> DataFrame:
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, packed, starts, ends in zip(*(batch[c].to_pylist() for c in ("doc_id", "packed", "starts", "ends")), strict=True):
                words = unpack(packed).split()
                gone = repeats.covered(len(words), starts, ends)
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if starts else b" ".join(words)
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                text = kept.decode("utf-8", "replace") if with_text else None
                out.append((doc_id, len(words), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), text))
            names = ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    joined = compressed(rows, "doc_id").join(spans, KEY, "left").select("doc_id", "packed", "starts", "ends")
    result = joined.mapInArrow(finish, RESULT)
    return result if with_text else result.drop("kept")
