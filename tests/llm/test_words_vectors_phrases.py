"""Spelling variants, near copies of vectors and collocations beside brute force, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensormill.llm import collocations, embedding_dedup, spelling, tiles

DOCS = "doc_id bigint, text string, lang string, n bigint, word string, tile string"


def docs(spark, rows):
    """With extra columns whose names the operators use themselves."""
    full = [(i, text, lang, 7, "w", "t") for i, text, lang in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


# Spelling variants


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _edits_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, slip, least_letters=5, least_count=3):
    n = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_letters and k >= least_count}
    near = {w: sorted((-n[v], v) for v in n if _edits_one(w, v)) for w in n}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 2 * n[w] else None for w in n}
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def variants(spark, rows, slip=97):
    found = spelling.variants(docs(spark, rows), slip=slip).collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found}
    assert len(got) == len(found)
    return got


def _words(seed, count):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abé", k=rng.randint(4, 7))) for _ in range(25)]
    out = []
    for _ in range(count):
        word = rng.choice(stems[: rng.randint(1, 25)])
        at = rng.randrange(len(word))
        out.append(rng.choice([word, word, word[:at] + word[at + 1 :], word[:at] + rng.choice("abéÉ") + word[at:], word.upper()]))
    return out


@pytest.mark.parametrize(("seed", "tile"), [(1, 4096), (2, 3)])
def test_variants_equal_all_pairs(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(spelling, "TILE", tile)  # tiles of three words: large blocks are dealt and meet each other
    words = _words(seed, 1500)
    rows = [(i, " ".join(words[i * 50 : i * 50 + 50]) + ", x1y", "en") for i in range(30)]
    assert variants(spark, rows, slip=7) == brute_variants(rows, slip=7)


@pytest.mark.parametrize("at_once", [1, 30, 100_000])
def test_near_pairs_in_steps_of_any_size(monkeypatch, at_once):
    monkeypatch.setattr(spelling, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    made = {n: sorted({"".join(rng.choices("abij", k=n)) for _ in range(60)}) for n in (4, 5)}
    tiles_ = {n: spelling.Words(words, np.ones(len(words), dtype=np.int64)) for n, words in made.items()}
    for one, two in ((4, 4), (4, 5)):
        a, b = tiles_[one], tiles_[two]
        found = [frozenset((a.words[i], b.words[j])) for i, j in ((int(i), int(j)) for x, y in spelling.near_pairs(a, b, one == two) for i, j in zip(x, y, strict=True))]
        assert sorted(map(sorted, found)) == sorted(sorted(p) for p in {frozenset((x, y)) for x in made[one] for y in made[two] if _edits_one(x, y)})


def test_variants_of_unusual_texts(spark):
    long = "ab" * 3000
    rows = [
        (None, None, None),
        (None, "zebras zebras zebras", None),
        (1, "", "en"),
        (1, "Zebra zebra ZEBRA zebra zebra zebra zebra", "en"),
        (1, "Zebra zebra ZEBRA zebra zebra zebra zebra", "en"),  # a repeated row counts again
        (2, f"{long} {long} {long} {long}c {long}c {long}c {long}cc {long}cc {long}cc", "de"),  # beyond exact 32-bit squares
        (3, "À×÷ÿa À×÷ÿa À×÷ÿa à×÷ÿa à×÷ÿa à×÷ÿa 12 中文", "fr"),
        (4, "aaaaaa " * 3 + "aaaaaaa " * 3 + "aaaaaaaa " * 6 + "aaaaab " * 12 + "aaaaac " * 12, "en"),  # ties, chains
    ]
    assert variants(spark, rows) == brute_variants(rows, 97)
    assert variants(spark, []) == {}
    assert variants(spark, [(1, None, None), (2, "a b", None)]) == {}


def test_every_one_edit_lies_in_a_known_block():
    moves = {*spelling.EDITS, *(tuple(-x for x in e) for e in spelling.EDITS)}
    letters = [spelling._FIRST[0], spelling._SECOND[0], next(c for c in spelling._ALL if c not in spelling._FIRST + spelling._SECOND)]

    def block(word):
        return len(word), sum(c in spelling._FIRST for c in word), sum(c in spelling._SECOND for c in word)

    for a in letters:
        for b in ["", *letters]:
            assert tuple(y - x for x, y in zip(block("qq" + a), block("qq" + b), strict=True)) in moves


# Near copies of vectors


def brute_copies(vectors, threshold):
    n = len(vectors)
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    links = defaultdict(set)
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(vectors[i]) == len(vectors[j]):
                if embedding_dedup.exact_cosine(np.array(vectors[i]), np.array(vectors[j])) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            least = min([root[i], *(root[j] for j in links[i])])
            changed |= least != root[i]
            root[i] = least
    return [(len(links[i]), root[i]) for i in range(n)]


def copies(spark, rows, kind="float", threshold=0.95):
    ddl = f"vec_id bigint, embedding array<{kind}>, copies bigint, width bigint, root bigint"
    df = spark.createDataFrame([(i, v, 5, 5, 5) for i, v in rows], ddl).repartition(3)
    return embedding_dedup.near_copies(df, threshold)


@pytest.mark.parametrize(("width", "tile", "threshold"), [(5, 4096, 0.95), (40, 8, 0.9), (33, 8, 0.5)])
def test_near_copies_equal_all_pairs(spark, monkeypatch, width, tile, threshold):
    monkeypatch.setattr(embedding_dedup, "TILE_BYTES", tile * 8 * width)
    rng = np.random.default_rng(width)
    seeds = rng.normal(size=(12, width))
    near = seeds[rng.integers(0, 12, 60)] + rng.normal(size=(60, width)) * rng.choice([0.02, 0.3, 0.6], size=(60, 1))
    near[rng.integers(0, 60, 8)] *= 3.0
    vectors = np.concatenate([seeds, near, near[:9], rng.normal(size=(20, width))]).astype(np.float32)
    lists = [[float(x) for x in v] for v in vectors]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in copies(spark, list(enumerate(lists)), threshold=threshold).collect()}
    expected = brute_copies(lists, threshold)
    assert found == {i: (n, root, root == i) for i, (n, root) in enumerate(expected)}
    assert sum(n for n, _ in expected) > 20


def test_vectors_that_take_no_part_and_ids_that_repeat(spark):
    nan, inf = float("nan"), float("inf")
    tiny, huge = 5e-324, 1.7e308
    rows = [
        (3, None), (3, []), (4, [0.0, -0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]),
        (9, [huge, huge]), (9, [tiny, tiny]), (10, [1.0, 1.0, 0.0]), (11, [2.0]), (12, [-2.0]), (13, [3.0]), (14, [1.0, 1.0]), (14, [-1.0, -1.0]),
    ]
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in copies(spark, rows, "double").collect()), key=str)
    alone = [(3, 0, 3, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (10, 0, 10, True), (12, 0, 12, True), (14, 0, 14, True)]
    linked = [(9, 3, 9, True), (9, 3, 9, False), (14, 3, 9, False), (None, 3, 9, False), (11, 1, 11, True), (13, 1, 11, False)]
    assert found == sorted([*alone, *linked], key=str)
    assert copies(spark, []).count() == 0
    assert [(r.n_links, r.kept) for r in copies(spark, [(1, None)]).collect()] == [(0, True)]


def test_pairs_at_the_threshold_are_decided_exactly():
    axes = np.eye(4)
    threshold = 0.95
    a = np.array([[1.0, 0.0, 0.0, 0.0]])
    rest = math.sqrt(1 - threshold**2)
    b = np.array([[threshold, rest, 0.0, 0.0], [threshold - 1e-12, rest, 0.0, 0.0], [threshold + 1e-12, rest, 0.0, 0.0]])
    one = embedding_dedup.Vectors(np.array([1]), np.array([1]), a, axes)
    two = embedding_dedup.Vectors(np.array([2, 3, 4]), np.array([1, 1, 1]), b, axes)
    found = {int(j) for _, cols in embedding_dedup.linked_pairs(one, two, threshold, False) for j in cols}
    assert found == {j for j in range(3) if embedding_dedup.exact_cosine(a[0], b[j]) >= threshold}


@pytest.mark.parametrize("rows", [1, 7, 512])
def test_linked_pairs_in_steps_of_any_size(monkeypatch, rows):
    monkeypatch.setattr(embedding_dedup, "ROWS", rows)
    rng = np.random.default_rng(rows)
    given = np.concatenate([rng.normal(size=(20, 70)), np.repeat(rng.normal(size=(3, 70)), 8, axis=0) + rng.normal(size=(24, 70)) * 0.2])
    axes = np.linalg.qr(rng.normal(size=(70, 70)))[0]
    block = embedding_dedup.Vectors(np.arange(44), np.ones(44, dtype=np.int64), given, axes)
    found = [(int(i), int(j)) for a, b in embedding_dedup.linked_pairs(block, block, 0.95, True) for i, j in zip(a, b, strict=True)]
    expected = [(i, j) for i in range(44) for j in range(i + 1, 44) if embedding_dedup.exact_cosine(given[i], given[j]) >= 0.95]
    assert sorted(found) == expected and len(expected) > 10


def test_tiles_meet_once(spark):
    cells = [(0, 0, 5), (0, 1, 9), (2, 0, 3)]
    rows = spark.createDataFrame([(x, y, f"{x}{y}{i}") for x, y, n in cells for i in range(n)], "x long, y long, name string")
    made = tiles.gathered(tiles.dealt(rows, ["x", "y"], "name", F.lit(2)), ["x", "y"], F.struct("name"))
    offsets = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    met = tiles.meetings(made, ["x", "y"], offsets).collect()
    names = {r.tile: {m.name for m in r.members} for r in made.collect()}
    pairs = Counter()
    for r in met:
        for a in names[r.tile_a]:
            for b in names[r.tile_b]:
                if r.tile_a != r.tile_b or a < b:
                    pairs[frozenset((a, b))] += 1
    every = [(r.name, r.x, r.y) for r in rows.collect()]
    expected = {frozenset((a[0], b[0])) for a in every for b in every if a[0] < b[0] and abs(a[1] - b[1]) <= 1 and abs(a[2] - b[2]) <= 1}
    assert set(pairs) == expected and set(pairs.values()) == {1}


# Collocations


def brute_collocations(rows, least, share=100, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", _lower(text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= least and len(p) >= 2}
        found = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def collocated(spark, rows, **others):
    found = collocations.collocations(docs(spark, rows), **others)
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())


@pytest.mark.parametrize(("least", "bits"), [(3, collocations.BITS), (5, 7)])
def test_collocations_equal_all_phrases(spark, least, bits):
    """In small chunks, and with a bit map that is full."""
    rng = random.Random(least)
    words = ["a", "B", "cé", "de", "中", "f'g", "h i"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(40))
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None])))
    assert collocated(spark, rows, least=least, chunk=60, bits=bits) == brute_collocations(rows, least)
    assert collocated(spark, rows, least=least, share=60, top=7) == brute_collocations(rows, least, 60, 7)


@pytest.mark.parametrize("dense", [1, 4, 1000])
def test_tiles_count_pairs(monkeypatch, dense):
    monkeypatch.setattr(collocations, "SIDE", 4)
    monkeypatch.setattr(collocations, "DENSE", dense)
    rng = np.random.default_rng(dense)
    x, y = (np.minimum(rng.geometric(0.2, 900), 30) for _ in range(2))
    pairs_x, pairs_y, n, place = collocations.tile_counts(x, y)
    assert dict(zip(zip(pairs_x.tolist(), pairs_y.tolist(), strict=True), n.tolist(), strict=True)) == Counter(zip(x.tolist(), y.tolist(), strict=True))
    assert (pairs_x[place] == x).all() and (pairs_y[place] == y).all() and len(set(zip(pairs_x.tolist(), pairs_y.tolist(), strict=True))) == len(n)


@pytest.mark.parametrize("size", [1, 3, 11, 1000])
def test_texts_are_split_by_slices(monkeypatch, size):
    monkeypatch.setattr(collocations, "SLICE", size)
    for text in ("Ab  c,d\te.\n\x0bf É中\r", "", ",", "lone", "x" * 50 + " y", " \t "):
        words = [w for part in collocations.split_words(text.encode()) for w in part if w]
        expected = []
        for k, piece in enumerate(re.split("[.,;:!?\x0a-\x0d]", _lower(text))):
            expected += [b"\n"] * (k > 0) + [w.encode() for w in re.split("[ \t]+", piece) if w]
        assert words == expected


def test_packed_forms_come_back():
    rng = np.random.default_rng(1)
    for size, top in ((2, 9), (5, 1 << 40)):
        grams = np.unique(rng.integers(0, top, (200, size)), axis=0)
        n = rng.integers(1, 1 << 20, len(grams))
        back, counts = collocations.unpack_counts(collocations.pack_counts(grams, n))
        assert (back == grams).all() and (counts == n).all()
        every, sums = collocations.add_up([grams, grams[:5]], [n, n[:5]])
        assert (every == grams).all() and (sums == n + np.r_[n[:5], np.zeros(len(n) - 5, int)]).all()
    none = np.zeros((0, 3), dtype=np.int64)
    assert collocations.unpack_counts(collocations.pack_counts(none, np.zeros(0, dtype=np.int64)))[0].shape == (0, 3)
    text = np.array([-1, -1, 70_000, 3, -1, 0, -1, -1])
    import pyarrow as pa

    assert collocations.unpacked(pa.scalar(collocations.packed(text))).tolist() == [-1, 70_000, 3, -1, 0, -1]


def test_collocations_of_unusual_texts(spark):
    rows = [
        (1, None, None), (None, "", "en"), (2, " \t ,.", "en"), (3, "x " * 300, "en"), (3, "x " * 300, "en"),
        (4, "one two three four five six. " * 5, None), (5, "lone", "zz"), (6, "p" * 40 + " q " + "p" * 40, "de"),
    ]
    assert collocated(spark, rows, least=3) == brute_collocations(rows, 3)
    assert collocated(spark, [], least=3) == []
    assert collocated(spark, [(1, None, None)], least=3) == []
    assert collocated(spark, [(1, "a b c", "en")], least=100) == []


def test_scores_beyond_64_bits_are_exact(spark):
    # The query's own expression on large counts: 1000 * a * n has 37 digits.
    a, n, left, right = 10**16 - 1, 10**17 - 3, 10**16 - 1, 10**16 + 0
    row = spark.createDataFrame([(a, n, [left], [right - 1])], "a bigint, n bigint, heads array<bigint>, tails array<bigint>")
    found = row.select(F.expr(collocations.LOWEST_CUT).alias("c")).first().c
    assert found.score == 1000 * a * n // (left * (right - 1))
