"""Substring deduplication over bytes by winnowing with fingerprints, in place of prefix doubling over a suffix array.

There are no ranks, no growing offsets and no rounds until every suffix is unique:

* Anchors: every 400-byte string owns one sampled start of a 300-byte prefix (its smallest by hash), so only every 50th
  suffix enters a sort. An anchor whose fingerprint is unique drops out, and anchors that agree in all that their sample
  stands for are settled together by a fingerprint of their surroundings.
* Windows: the 400-byte windows still open are sorted once by the pair of fingerprints of their first and last 300
  bytes, which overlap.

Results are whole up to equal 64-bit fingerprints of different strings. Doubling over every suffix would, as computed,
sort 16 bytes or more per byte of text in every round; the sample makes that 0.5. A try of doubling was not measured.

A byte goes if a ``width``-byte string over it also starts anywhere else, in the same text or another one. Strings are
judged on the input and never cross texts. NULL counts as empty; texts shorter than the threshold lose nothing; repeated
rows and ids are separate texts and so lose what they share. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensormill.llm import repeats
from sensormill.llm.fingerprints import BYTE_VALUES
from sensormill.llm.tables import KEY, compressed, keyed, unpack

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def units(body: bytes) -> np.ndarray:
    return BYTE_VALUES[np.frombuffer(body, dtype=np.uint8)]


def _judge(key: np.ndarray, kind: np.ndarray, leaders: np.ndarray, many: np.ndarray):
    """All rows of a class met twice go whole; the first one stands for the class where the seed has more classes."""
    first = np.zeros(len(key), dtype=bool)
    first[leaders] = True
    return np.bincount(kind)[kind] > 1, first & many


def _decide(key: np.ndarray, kind: np.ndarray, leaders: np.ndarray):
    """Windows met twice in the batch go; the first and the last row may have their equals elsewhere."""
    rim = np.zeros(len(key), dtype=bool)
    rim[[0, -1]] = True
    return np.bincount(kind)[kind] > 1, rim


def _twice(rim: DataFrame) -> DataFrame:
    return rim.join(rim.groupBy("head", "tail").count().filter("count > 1"), ["head", "tail"])


def repeated_spans(rows: DataFrame, width: int) -> DataFrame:
    first = max(width * 3 // 4, 1)
    settled = repeats.settle(repeats.anchor_rows(rows, units, width, first), _judge)
    found = repeats.open_windows(rows, settled, units, width, first)
    return repeats.removal_spans(settled, repeats.repeated_windows(found, _decide, _twice), width)


def remove_repeats(docs: DataFrame, width: int = 400, with_bytes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes."""
    rows = keyed(docs)
    spans = repeated_spans(rows, width)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("doc_id", "packed", "starts", "ends")]
            for doc_id, packed, starts, ends in zip(*columns, strict=True):
                body = unpack(packed)
                gone = repeats.covered(len(body), starts, ends)
                kept = np.frombuffer(body, dtype=np.uint8)[~gone].tobytes() if starts else body
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                digest = hashlib.sha256(kept).hexdigest()
                out.append((doc_id, len(body), int(gone.sum()), runs, digest, kept if with_bytes else None))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    joined = compressed(rows, "doc_id").join(spans, KEY, "left").select("doc_id", "packed", "starts", "ends")
    result = joined.mapInArrow(finish, RESULT)
    return result if with_bytes else result.drop("kept")
