"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

A word's letter counts are a vector. One replaced letter moves it by a squared distance of 0 or 2, one inserted or
deleted letter by 1, so words one edit apart have a squared distance of at most 2 and lengths that differ by at most one.

1. Words (see ``corpus_words``) are counted in Spark.
2. Blocks: words of one length with the same counts in three classes of letters. An edit leads to one of 13 blocks around
   a word's own; each pair of blocks is looked at once, a block's own length and the next one included. Large blocks are
   dealt into tiles of at most about ``TILE`` words.
3. A pair of tiles is compared in a task. Words with equal counts in eight classes of letters form a group; a product of
   the groups' vectors tells which groups are within the distance, and products of their words' vectors (NumPy, 32 letter
   counts) give squared distances. Pairs at most two apart are verified by the letters themselves.
4. A task returns, per word, how many near words it met and the most frequent of them. No pair becomes a row.
5. A word's form is its most frequent near word if that is at least ``ratio`` times as frequent. Counts grow along the
   forms, so they end; roots are found by pointer jumping, each round written to the shared folder.

The work is quadratic in the words of neighbouring blocks, by the method; the grouping keeps it to some hundredths of all
pairs. NULL texts have no words. A NULL id counts as an empty one in the hash. Repeated rows count again. Other columns are
ignored. Words may be of any length. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm.tiles import brought_together, dealt, gathered, meetings
from sensormill.workspace import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words and letters that a tile holds at most (about: tiles are dealt by hash).
TILE, TILE_LETTERS = 4096, 1 << 20
#: Products and comparisons inside a task hold about as many numbers as this.
AT_ONCE = 1 << 21
LETTERS, CLASSES = 32, 8
#: Letters of words are code points below 256. a-z have a count each, accented letters share six.
_CODES = np.arange(256)
_LETTER = np.where((_CODES >= 97) & (_CODES < 123), _CODES - 97, 26 + _CODES % 6)
_CLASS = _CODES % CLASSES
#: The three classes of letters that make blocks, as unions of the eight.
_ALL = [chr(c) for c in range(97, 123)] + [chr(c) for c in range(0xC0, 0x100)]
_FIRST = "".join(c for c in _ALL if ord(c) % CLASSES in (0, 1, 2))
_SECOND = "".join(c for c in _ALL if ord(c) % CLASSES in (3, 4))
BLOCK = ["size", "first", "second"]
#: Changes of (length, letters of the first class, of the second) by one edit, one of each two opposite ones.
EDITS = [(0, 0, 0), (0, -1, 1), (0, -1, 0), (0, 0, -1), (1, 1, 0), (1, 0, 1), (1, 0, 0)]

_FOUND = "word string, near long, best_n long, best string"


def corpus_words(docs: DataFrame, slip: int | None = 97) -> DataFrame:
    """(word, n): runs of letters of all texts, with only A-Z lower-cased.

    With ``slip``, a run whose CRC-32 of ``<doc_id>:<run>`` that number divides loses one letter: spelling mistakes
    planted by rule.
    """
    lowered = F.translate("text", UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit("([a-zÀ-ÿ]+)"), F.lit(1))).alias("run"),
    )
    if slip is not None:
        code = F.crc32(F.concat_ws(":", "_id", "run").cast("binary"))
        runs = runs.withColumn("_code", code)
        at = F.expr("cast(_code % length(run) as int)")
        cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
        runs = runs.select(F.when(F.col("_code") % slip == 0, cut).otherwise(F.col("run")).alias("run"))
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).filter("word <> ''")


class Words:
    """The words of one tile, all of one length, sorted into groups of equal class counts."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.size, rows = len(words[0]), len(words)
        codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(rows, self.size)
        classes = _histogram(codes, _CLASS, CLASSES)
        self.groups, place = np.unique(classes, axis=0, return_inverse=True)
        order = np.argsort(place.ravel(), kind="stable")
        self.words, self.n, self.codes = [words[i] for i in order], counts[order], codes[order]
        self.begins = np.searchsorted(place.ravel()[order], np.arange(len(self.groups) + 1))
        # Whole numbers must stay exact in the products.
        self.kind = np.float32 if self.size < 2048 else np.float64
        self.vectors = _histogram(self.codes, _LETTER, LETTERS).astype(self.kind)
        self.squares = (self.vectors * self.vectors).sum(axis=1)


def _histogram(codes: np.ndarray, lookup: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(codes), width), dtype=np.int64)
    step = max(1, AT_ONCE // max(codes.shape[1], 1))
    for begin in range(0, len(codes), step):
        part = lookup[codes[begin : begin + step]]
        flat = (np.arange(len(part))[:, None] * width + part).ravel()
        out[begin : begin + step] = np.bincount(flat, minlength=len(part) * width).reshape(len(part), width)
    return out


def squared_distances(left: np.ndarray, right: np.ndarray, left_squares: np.ndarray, right_squares: np.ndarray) -> np.ndarray:
    """By the Gram matrix: |a|^2 + |b|^2 - 2ab."""
    return left_squares[:, None] + right_squares[None, :] - 2 * (left @ right.T)


def near_pairs(one: Words, two: Words, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of words one edit apart; ``two`` is of the same length or longer by one."""
    found_a, found_b, waiting = [], [], 0
    limit = max(1, AT_ONCE // one.size)
    theirs = two.groups.astype(np.float64)
    their_squares = (theirs * theirs).sum(axis=1)
    for group, (begin, end) in enumerate(zip(one.begins[:-1].tolist(), one.begins[1:].tolist(), strict=True)):
        own = one.groups[group : group + 1].astype(np.float64)
        distance = squared_distances(own, theirs, (own * own).sum(axis=1), their_squares)[0]
        close = np.flatnonzero(distance <= 2)
        if itself:
            close = close[close >= group]
        if not len(close):
            continue
        reach = np.concatenate([np.arange(two.begins[c], two.begins[c + 1]) for c in close.tolist()])
        rows = max(1, AT_ONCE // len(reach))
        for start in range(begin, end, rows):
            upto = min(start + rows, end)
            gram = squared_distances(one.vectors[start:upto], two.vectors[reach], one.squares[start:upto], two.squares[reach])
            a, b = np.nonzero(gram <= 2)
            a, b = a + start, reach[b]
            if itself:
                later = a < b
                a, b = a[later], b[later]
            for cut in range(0, len(a), limit):
                found_a.append(a[cut : cut + limit])
                found_b.append(b[cut : cut + limit])
                waiting += len(found_a[-1])
                if waiting >= limit:
                    yield _one_edit(one, two, np.concatenate(found_a), np.concatenate(found_b))
                    found_a, found_b, waiting = [], [], 0
    if waiting:
        yield _one_edit(one, two, np.concatenate(found_a), np.concatenate(found_b))


def _one_edit(one: Words, two: Words, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that differ by exactly one replaced letter, or by one that the longer word has more."""
    left, right = one.codes[a], two.codes[b]
    if one.size == two.size:
        good = (left != right).sum(axis=1) == 1
        return a[good], b[good]
    ahead = left == right[:, :-1]
    first_bad = np.where(ahead.all(axis=1), one.size, np.argmin(ahead, axis=1))
    behind = left == right[:, 1:]
    last_bad = np.where(behind.all(axis=1), -1, one.size - 1 - np.argmin(behind[:, ::-1], axis=1))
    good = last_bad < first_bad
    return a[good], b[good]


class _Best:
    """Per word of a tile: how many near words, and the one of largest n (ties: smallest in code-point order)."""

    def __init__(self, words: Words):
        self.words = words
        self.near, self.best_n = np.zeros(len(words.words), dtype=np.int64), np.zeros(len(words.words), dtype=np.int64)
        self.best: dict[int, str] = {}

    def add(self, own: np.ndarray, other: np.ndarray, theirs: Words) -> None:
        self.near += np.bincount(own, minlength=len(self.near))
        n = theirs.n[other]
        better = n >= self.best_n[own]
        own, other, n = own[better], other[better], n[better]
        order = np.lexsort((-n, own))
        own, other, n = own[order], other[order], n[order]
        begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
        most = n == np.repeat(n[begins], np.diff(np.r_[begins, len(own)]))
        for i, j, count in zip(own[most].tolist(), other[most].tolist(), n[most].tolist(), strict=True):
            if count > self.best_n[i] or (count == self.best_n[i] and theirs.words[j] < self.best[i]):
                self.best_n[i], self.best[i] = count, theirs.words[j]

    def batch(self) -> pa.RecordBatch:
        found = np.flatnonzero(self.near)
        columns = [
            pa.array([self.words.words[i] for i in found.tolist()], pa.string()),
            pa.array(self.near[found]),
            pa.array(self.best_n[found]),
            pa.array([self.best[i] for i in found.tolist()], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["word", "near", "best_n", "best"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = _tile(batch["members_a"], row)
            itself = batch["tile_a"][row] == batch["tile_b"][row]
            two = one if itself else _tile(batch["members_b"], row)
            left = _Best(one)
            right = left if itself else _Best(two)
            for a, b in near_pairs(one, two, itself):
                left.add(a, b, two)
                right.add(b, a, one)
            yield left.batch()
            if not itself:
                yield right.batch()


def _tile(members: pa.Array, row: int) -> Words:
    content = members[row].values
    return Words(content.field("word").to_pylist(), content.field("n").to_numpy(zero_copy_only=False))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best, best_n) for the words (word, n), each once: near words and the most frequent of them."""
    blocks = words.select(
        "word", "n", F.length("word").cast("long").alias("size"),
        (F.length("word") - F.length(F.translate("word", _FIRST, ""))).cast("long").alias("first"),
        (F.length("word") - F.length(F.translate("word", _SECOND, ""))).cast("long").alias("second"),
    )
    room = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_LETTERS) / F.col("size"))))
    tiles = materialise(gathered(dealt(blocks, BLOCK, "word", room), BLOCK, F.struct("word", "n")), "word-tiles")
    pairs = brought_together(meetings(tiles, BLOCK, EDITS), tiles, "word-tile-pairs")
    found = pairs.mapInArrow(_compare, _FOUND).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("top")
    )
    known = words.select("word", "n").join(found, "word", "left")
    return known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def variants(docs: DataFrame, least_letters: int = 5, least_count: int = 3, ratio: int = 2, slip: int | None = 97) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all words that are long and frequent enough."""
    counted = corpus_words(docs.select("doc_id", "text"), slip).filter(F.length("word") >= least_letters)
    words = materialise(counted.filter(F.col("n") >= least_count), "words")
    near = near_words(words)
    is_form = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    formed = materialise(near.select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.filter("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return formed.join(roots.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))
