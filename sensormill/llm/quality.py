"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

Grades come from the labels: 0 for poor text, 1 for toxic text of fair quality, 2 for clean text. One weight per hashed
feature is shared by all grades; ordered thresholds c1 < c2 cut the score: P(grade >= k) = sigmoid(score - ck). Every
document gets its expected grade and the tail probability of the top grade, by which documents are selected.

Features are what a text holds, each once: its words (A-Z lower-cased, digits, letters, anything beyond ASCII), the
first 4, 5 and 6 characters of its words, and marks of its shape (how common capitals, symbols, repeats and dividers
are, in coarse steps).

The model is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of their id, so a rerun and a
larger table behave alike. Features in fewer than ``SEEN`` rows of the sample, and those that go with no grade beyond
chance, have weight 0. The model is therefore of bounded size and travels with the tasks; scoring is a map over all
documents, with no shuffle.

Labels with NULL grade parts or without a document are left out; repeated labels count repeatedly. If no two grades are
present, the model is empty and everything is kept. NULL and empty texts have no features and get the score 0. All
columns and all rows of the documents are kept by ``score``; the result is named so that it cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm.decontaminate import words_of
from sensormill.workspace import materialise

#: Labelled rows used for fitting, and how many of them must have a feature.
SAMPLE = 20_000
SEEN = 4
#: Standard deviations from chance that make a feature count.
SURE = 4.0
RIDGE = 0.00003
ROUNDS = 80
CACHE = 50_000
#: Chance of the top grade from which a document is selected.
LEAST = 0.6


def grade(quality: int, toxic: int) -> int:
    return 0 if quality == 0 else 1 if toxic else 2


def word_features(word: bytes) -> tuple[int, ...]:
    parts = {word, *(word[:n] + b"*" for n in (4, 5, 6) if len(word) > n)}
    return tuple(zlib.crc32(p) for p in parts)


def shape_features(body: bytes, words: list[bytes], different: int) -> list[int]:
    """Hashed marks of the text's shape, in steps of a tenth."""
    total = max(len(words), 1)
    symbols = sum(body.count(c) for c in (b"!", b"#", b"$", b"%", b"&", b"*", b"|"))
    capitals = sum(body.count(c) for c in _CAPITALS)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    shares = {
        b"capitals": capitals / max(len(body), 1),
        b"symbols": symbols / total,
        b"dividers": body.count(b"|") / total,
        b"exclaim": body.count(b"!!") / total,
        b"repeats": same / total,
        b"variety": different / total if total < 200 else 1.0,
        b"length": min(total, 100) / 100,
    }
    return [zlib.crc32(b"\x00" + name + b"%d" % min(int(share * 10), 20)) for name, share in shares.items()]


_CAPITALS = [bytes([c]) for c in range(65, 91)]


class Features:
    """Features of texts, with those of common words kept from text to text."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, ...]] = {}

    def of(self, body: bytes) -> set[int]:
        words = words_of(body)
        found = set(words)
        out = set(shape_features(body, words, len(found))) if words else set()
        if len(self.known) > CACHE:
            self.known = {}
        known = self.known
        for word in found:
            features = known.get(word)
            if features is None:
                features = known[word] = word_features(word)
            out.update(features)
        return out


@dataclass
class Model:
    weights: dict[int, float]
    cuts: tuple[float, float]

    def tails(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= 1) and P(grade >= 2)."""
        first, second = (1 / (1 + np.exp(np.clip(c - scores, -500, 500))) for c in self.cuts)
        return first, second


def fit_rows(places: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, grades: np.ndarray) -> Model:
    """Penalised maximum likelihood, grades weighing alike; ``places`` are the features of all rows, one after another."""
    present, n, width = np.unique(grades), len(grades), len(hashes)
    if len(present) < 2:
        return Model({}, (-1.0, -1.0))
    share = 1 / (len(present) * np.bincount(grades, minlength=3)[grades])
    ends = np.cumsum(sizes)
    chunks = [(i, min(i + 1024, n)) for i in range(0, n, 1024)]  # rows at a time, so that temporaries stay small

    def part(begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        own = np.repeat(np.arange(end - begin), sizes[begin:end])
        return own, places[ends[begin] - sizes[begin] : ends[end - 1]]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        """Value and gradient; the last two are the first cut and the logarithm of its distance to the second."""
        score = np.empty(n)
        for begin, end in chunks:
            own, at = part(begin, end)
            score[begin:end] = np.bincount(own, weights=w[at], minlength=end - begin)
        gap = np.exp(np.clip(w[-1], -20, 20))
        first, second = (1 / (1 + np.exp(np.clip(c - score, -500, 500))) for c in (w[-2], w[-2] + gap))
        upper, lower = np.choose(grades, [1.0, first, second]), np.choose(grades, [first, second, 0.0])
        chance = np.maximum(upper - lower, 1e-12)
        up, down = share * upper * (1 - upper) / chance, share * lower * (1 - lower) / chance
        out = np.empty_like(w)
        out[:-2] = RIDGE * w[:-2]
        for begin, end in chunks:
            own, at = part(begin, end)
            out[:-2] -= np.bincount(at, weights=(up - down)[begin:end][own], minlength=width)
        second_cut = up[grades == 2].sum() - down[grades == 1].sum()
        out[-2] = up[grades == 1].sum() - down[grades == 0].sum() + second_cut
        out[-1] = second_cut * gap
        return float(-(share * np.log(chance)).sum() + RIDGE / 2 * (w[:-2] ** 2).sum()), out

    start = np.zeros(width + 2)
    start[-2] = -1.0
    w = descend(loss, start)
    used = np.flatnonzero(np.abs(w[:width]) > 1e-6)
    weights = dict(zip(hashes[used].tolist(), w[used].tolist(), strict=True))
    return Model(weights, (float(w[-2]), float(w[-2] + np.exp(np.clip(w[-1], -20, 20)))))


def descend(loss, w: np.ndarray, rounds: int = ROUNDS, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving."""
    value, gradient = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        direction, kept = -gradient, []
        for step, change in reversed(past):
            a = (step @ direction) / (step @ change)
            direction = direction - a * change
            kept.append(a)
        if past:
            step, change = past[-1]
            direction = direction * ((step @ change) / (change @ change))
        for (step, change), a in zip(past, reversed(kept), strict=True):
            direction = direction + (a - (change @ direction) / (step @ change)) * step
        slope = float(gradient @ direction)
        if slope >= 0:
            direction, slope, past = -gradient, -float(gradient @ gradient), []
        size = 1.0 if past else 1.0 / max(1.0, float(np.abs(gradient).sum()))
        for _ in range(30):
            trial = w + size * direction
            new_value, new_gradient = loss(trial)
            if new_value <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        step, change = trial - w, new_gradient - gradient
        if step @ change > 1e-12:
            past = [*past, (step, change)][-memory:]
        done = value - new_value < 1e-7
        w, value, gradient = trial, new_value, new_gradient
        if done:
            break
    return w


def telling(rated: DataFrame) -> DataFrame:
    """(feature,): those in enough rows whose share of some grade and above differs from the sample's beyond chance."""
    counts = {f"above{k}": F.sum((F.col("grade") >= k).cast("double")) for k in (1, 2)}
    total = rated.agg(F.count("*").alias("rows"), *(c.alias("all_" + n) for n, c in counts.items()))
    seen = rated.select("grade", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("seen"), *(c.alias(n) for n, c in counts.items())
    )
    known = total.first()
    test = F.lit(False)
    for name in counts:
        share = (known["all_" + name] or 0.0) / max(known["rows"], 1)
        spread = F.sqrt(F.col("seen") * share * (1 - share) * (known["rows"] - F.col("seen")) / max(known["rows"] - 1, 1))
        test = test | (F.abs(F.col(name) - F.col("seen") * share) > SURE * F.greatest(spread, F.lit(1e-4)))
    return seen.filter((F.col("seen") >= SEEN) & test).select("feature")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from at most ``sample`` labelled rows.

    Features are made and counted in tasks; only the telling ones, about one row in a hundred, reach the driver, where
    the likelihood of the sample is maximised.
    """

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            sets = [sorted(features.of(b)) for b in batch["body"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["grade"], pa.array(sets, pa.list_(pa.int64()))], ["grade", "features"])

    parts = labels.select("doc_id", "quality", "toxic").dropna()
    chosen = parts.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(sample)
    rating = F.when(F.col("quality") == 0, 0).when(F.col("toxic") != 0, 1).otherwise(2)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("body")).filter("body IS NOT NULL")
    picked = rows.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of four numbers
    picked = picked.select(rating.alias("grade"), "body")
    rated = materialise(picked.mapInArrow(featurise, "grade int, features array<long>"), "rated")
    hashes = np.array(sorted(r.feature for r in telling(rated).collect()), dtype=np.int64)  # bounded by the sample

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for own in batch["features"].to_pylist():
                own = np.asarray(own, dtype=np.int64)
                at = np.searchsorted(hashes, own)
                found = at[(at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == own)] if len(hashes) else at[:0]
                kept.append(found.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch["grade"], pa.array(kept, pa.binary())], ["grade", "places"])

    found = sorted((r.grade, bytes(r.places)) for r in rated.mapInArrow(narrow, "grade int, places binary").collect())
    grades = np.array([g for g, _ in found], dtype=np.int64)
    sizes = np.array([len(p) // 4 for _, p in found], dtype=np.int64)
    return fit_rows(np.frombuffer(b"".join(p for _, p in found), dtype=np.int32), sizes, hashes, grades)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with expected_grade and p_top."""
    carried = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    names = [n for n in docs.columns if n not in ("expected_grade", "p_top")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, features = carried.value.weights, Features()
        for batch in batches:
            scores = []
            for text in batch["text"].to_pylist():
                found = features.of(text.encode()) if text else ()
                scores.append(sum(sorted(weights[f] for f in found if f in weights)))
            first, second = carried.value.tails(np.array(scores, dtype=np.float64))
            columns = [*(batch[n] for n in names), pa.array(first + second), pa.array(second)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "expected_grade", "p_top"])

    rows = docs.select(names)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(predict, f"{kinds}, expected_grade double, p_top double")


def select(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents whose chance of the top grade is at least ``least``, with their own columns."""
    others = F.struct(F.lit(0).alias("_"), *(F.col(c) for c in docs.columns if c != "text"))
    scored = score(docs.select("text", others.alias("_others")), fit(docs, labels)).filter(F.col("p_top") >= least)
    return scored.select(*("text" if c == "text" else F.col("_others")[c].alias(c) for c in docs.columns))
