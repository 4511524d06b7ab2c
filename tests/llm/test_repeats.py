"""Substring dedup over words and over bytes against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sensormill.llm import fingerprints, substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, _row string, body long"


def words_expected(rows, width):
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        rank = float("inf") if doc_id is None else doc_id
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            first[key] = min(first.get(key, float("inf")), rank)
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        rank, gone = float("inf") if doc_id is None else doc_id, [False] * len(words)
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < rank:
                gone[i : i + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def bytes_expected(rows, width):
    bodies = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    seen = Counter(b[i : i + width] for _, b in bodies for i in range(len(b) - width + 1))
    out = []
    for doc_id, body in bodies:
        gone = [False] * len(body)
        for i in range(len(body) - width + 1):
            if seen[body[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def check(spark, rows, word_width, byte_width):
    docs = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], SCHEMA)
    found = substring_dedup.remove_repeats(docs, word_width).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == words_expected(rows, word_width)
    found = suffix_dedup.remove_repeats(docs, byte_width).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == bytes_expected(rows, byte_width)


def texts(seed, vocabulary, count):
    random_ = random.Random(seed)
    base = [" ".join(random_.choice(vocabulary) for _ in range(random_.randint(0, 80))) for _ in range(count)]
    return [random_.choice([None, "", " ", *base, random_.choice(base) + "\t" + random_.choice(base)]) for _ in range(2 * count)]


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, "a b c dd é".split()), (2, [f"w{i}" for i in range(400)]), (3, ["a"])])
def test_unique_ids(spark, small_batches, seed, vocabulary):
    rows = [(i * 3 - 40, t) for i, t in enumerate(texts(seed, vocabulary, 30))]
    random.Random(seed).shuffle(rows)
    check(spark, rows, 6, 16)


def test_missing_and_repeated_ids(spark, small_batches):
    random_ = random.Random(9)
    check(spark, [(random_.choice([None, *range(12)]), t) for t in texts(4, "a b c".split(), 25)], 5, 12)


def test_long_text_and_group_of_copies(spark):
    random_ = random.Random(5)
    passage = " ".join(random_.choice("abcdef") * random_.randint(1, 4) for _ in range(90))
    long_text = " ".join(str(random_.randrange(3000)) for _ in range(60_000))
    rows = [(i, f"{i} {passage} {i * i}") for i in range(300)] + [(1000, long_text), (1001, long_text[1000:200_000])]
    check(spark, rows, 13, 400)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.remove_repeats(docs).count() == 0 and suffix_dedup.remove_repeats(docs).count() == 0


def test_kept_text(spark):
    rows = [(1, "a b c d e"), (2, "x a b c d e y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in substring_dedup.remove_repeats(docs, 4, with_text=True).collect()}
    assert kept == {1: "a b c d e", 2: "x y"}
    whole = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(docs, 9, with_bytes=True).collect()}
    assert whole == {1: b"", 2: b"x  y"}


def test_windows_across_segments():
    units = np.random.default_rng(1).integers(0, 1 << 40, fingerprints.SEGMENT * 2 + 50, dtype=np.uint64)
    names = fingerprints.windows(units, 7)
    assert len(names) == len(units) - 6 and len(np.unique(names)) == len(names)
    again = fingerprints.windows(units[fingerprints.SEGMENT - 3 :], 7)
    assert np.array_equal(names[fingerprints.SEGMENT - 3 :], again)
    owned = [(first, count) for _, _, firsts, counts, _ in fingerprints.anchors(units, 7, 3) for first, count in zip(firsts, counts, strict=True)]
    assert sum(c for _, c in owned) == len(names)


def test_words_longer_than_a_segment():
    huge = b"x" * (fingerprints.SEGMENT + 5)
    values = fingerprints.word_units([b"a", huge, b"a", huge + b"y"])
    assert values[0] == values[2] and len(set(values.tolist())) == 3
