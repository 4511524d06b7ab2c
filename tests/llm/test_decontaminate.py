"""FM-index and decontamination against plain search."""

import hashlib
import random
import re

import numpy as np

from sensormill.llm import decontaminate
from sensormill.llm.fm_index import FMIndex, WaveletTree

DOCS = "doc_id long, text string, n_chars long, _starts string, _others int"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(docs, items, width):
    known = {}
    for item, text in items:
        own = words(text)
        for i in range(max(len(own) - width + 1, min(len(own), 1))):
            known.setdefault(tuple(own[i : i + width]), set()).add("NULL" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        own = words(text)
        hit, found = [False] * len(own), set()
        for size in {len(k) for k in known}:
            for i in range(len(own) - size + 1):
                if (key := tuple(own[i : i + size])) in known:
                    hit[i : i + size] = [True] * size
                    found |= known[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), sum(hit), len(found), digest, any(hit)))
    return sorted(out, key=str)


def sample(seed=3):
    random_ = random.Random(seed)
    vocabulary = ["a", "B", "c9", "éT", "dd", "Ee"]
    items = [(i % 11 or None, " ".join(random_.choice(vocabulary) for _ in range(random_.choice([0, 1, 3, 7, 12])))) for i in range(25)]
    items += [(50, None), (51, "... !"), (52, items[3][1])]
    docs = []
    for i in range(120):
        text = " - ".join(random_.choice([*vocabulary, "other", "zz"]) for _ in range(random_.randint(0, 40)))
        docs.append((i // 2, random_.choice([text, text + " " + (random_.choice(items)[1] or ""), None, ""])))
    return docs, items


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, len(t or ""), "s", 5) for d, t in docs], DOCS),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, body int"),
    )


def test_spans(spark, small_batches, monkeypatch):
    docs, items = sample()
    for block in (8 << 20, 60):  # all items in one step, and a chain of steps
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        found = decontaminate.find_spans(*tables(spark, docs, items), width=6).drop("starts", "ends")
        assert sorted(map(tuple, found.collect()), key=str) == expected(docs, items, 6)


def test_shards_do_not_matter():
    docs, items = sample(4)
    bodies = [(t or "").encode() for _, t in docs]
    phrases = decontaminate.Phrases([(str(i), t.encode()) for i, t in items if t is not None], 6)
    together, alone = phrases.search(bodies), [phrases.search([b])[0] for b in bodies]
    assert [(decontaminate.merge(s), i) for s, i in together] == [(decontaminate.merge(s), i) for s, i in alone]


def test_cut(spark):
    docs = [(1, "Keep this. ONE two, three! and this"), (2, None), (3, "one two three"), (4, "")]
    frame, tests = tables(spark, docs, [(1, "one two three")])
    cut = decontaminate.cut_spans(frame, tests, width=3)
    rows = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == frame.columns
    assert [rows[i].text for i in (1, 2, 3, 4)] == ["Keep this. ! and this", None, "", ""]
    assert rows[1].n_chars == len(rows[1].text) and rows[1]._starts == "s" and rows[1]._others == 5


def test_empty_tables(spark):
    frame, tests = tables(spark, [(1, "a b")], [(1, "a")])
    none = decontaminate.find_spans(frame, tests.limit(0)).collect()
    assert len(none) == 1 and not none[0].contaminated
    assert decontaminate.find_spans(frame.limit(0), tests).count() == 0 == decontaminate.cut_spans(frame.limit(0), tests).count()


def test_index_finds_all_places():
    generator = np.random.default_rng(1)
    text = generator.integers(1, 5, 400)
    index = FMIndex(text)
    phrases = np.array([[-1, 1, 2], [3, 3, 3], [4, 1, 2], [-1, -1, 9]])
    low, high = index.search(phrases, np.array([2, 3, 3, 1]))
    for phrase, a, b in zip(([1, 2], [3, 3, 3], [4, 1, 2], [9]), low, high, strict=True):
        plain = [i for i in range(len(text) - len(phrase) + 1) if text[i : i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == plain


def test_wavelet_tree():
    values = np.random.default_rng(2).integers(0, 13, 200)
    tree = WaveletTree(values, 4)
    places = np.arange(200)
    assert np.array_equal(tree.at(places), values)
    for symbol in range(13):
        assert np.array_equal(tree.rank(np.full(200, symbol), places), [(values[:p] == symbol).sum() for p in places])
