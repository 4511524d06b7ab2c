"""N-gram Jaccard join against all pairs, and its parts."""

import random
from collections import Counter, defaultdict

import numpy as np

from sensormill.llm import jaccard
from sensormill.llm.components import components
from sensormill.llm.decontaminate import words_of


def expected(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        words = words_of((text or "").encode())
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))})
    links, group = [0] * len(rows), list(range(len(rows)))
    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if both and both >= threshold * len(one | sets[j]):
                links[i] += 1
                links[j] += 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    smallest = defaultdict(list)
    for (doc_id, _), g in zip(rows, group, strict=True):
        smallest[g].append(doc_id)
    return Counter((d, min(smallest[g]), n) for (d, _), g, n in zip(rows, group, links, strict=True))


def near_copies(count, seed=1):
    random_ = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)]
    base = [[random_.choice(vocabulary) for _ in range(random_.randint(1, 90))] for _ in range(12)]
    rows = []
    for i in range(count):
        words = list(random_.choice(base))
        for _ in range(random_.choice([0, 0, 1, 1, 2, 3])):
            words[random_.randrange(len(words))] = random_.choice(vocabulary)
        rows.append((i, random_.choice([" ".join(words)] * 15 + [None, "", "..", "Zoë"])))
    return rows


def test_links_and_classes(spark):
    rows = near_copies(300)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, links long, _row string")
    found = jaccard.linked(docs).select("doc_id", "class_id", "n_links")
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_large_clusters_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 4000)
    base = [f"v{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: 30 + i % 9], f"own{i % 70}", *base[30 + i % 9 :]])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.linked(docs).select("doc_id", "class_id", "n_links")
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_links_inside_a_cell_count_once_where_other_cells_are_empty(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 300)  # below the size of one document: more cells than documents
    monkeypatch.setattr(jaccard, "LEAST_LOAD", 1)
    rows = []
    for group in range(12):
        base = [f"g{group}v{i}" for i in range(400)]
        rows += [(10 * group + i, " ".join([*base[:-1], f"own{i}"])) for i in range(2 + group % 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.linked(docs).select("doc_id", "class_id", "n_links")
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_one_of_each(spark):
    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (9, "x y z"), (7, None), (8, None)]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, class_id string")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 7, 8, 9]
    twice = docs.unionByName(docs.limit(1))  # ids no longer name rows
    assert jaccard.one_of_each(twice).count() == 4


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.linked(docs).count() == 0 and jaccard.one_of_each(docs).count() == 0


def test_pruning_keeps_what_can_reach_the_threshold():
    steps = range(16, 145, 16)
    least = jaccard.least_matches(0.8, 1e-6, steps)
    assert least == sorted(least) and all(0 < m < 0.8 * k for m, k in zip(least, steps, strict=True))


def test_products_equal_single_comparisons():
    generator = np.random.default_rng(2)
    sets = [np.unique(generator.integers(0, 300, 120).astype(np.uint64)) for _ in range(40)]
    a, b = np.triu_indices(40, 1)
    one_by_one = [jaccard._common(sets[i], sets[j]) for i, j in zip(a, b, strict=True)]
    assert jaccard._products(sets, a, b).tolist() == one_by_one


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
