"""Held-out accuracy of the classifier, the mix against its rules, and the stages of the pipeline."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from sensormill.llm import mixing, quality

SMALL = "/root/testdata/sf0.001"


def rated_texts(count, seed=1):
    random_ = random.Random(seed)
    words = [a + b for a in "ba de fi go lu mo ne ri sa tu".split() for b in "nd rk st lt mp x".split()]
    bad = ["vile", "nasty", "rotten"]
    docs, labels = [], []
    for i in range(count):
        own = [random_.choice(words) for _ in range(random_.randint(5, 60))]
        kind = random_.choice(["clean", "clean", "toxic", "poor"])
        if kind == "toxic":
            own.insert(random_.randrange(len(own)), random_.choice(bad))
        if kind == "poor":
            own = [w.upper() + "!!" for w in own]
        docs.append((i, " ".join(own), kind))
        labels.append((i, int(kind != "poor"), int(kind == "toxic")))
    return docs, labels


def test_classifier_on_held_out_texts(spark):
    docs, labels = rated_texts(900)
    frame = spark.createDataFrame(docs, "doc_id long, text string, p_top string")
    rated = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(frame, rated.filter("doc_id < 600"))
    assert model.cuts[0] < model.cuts[1]
    kept = {r.doc_id for r in quality.select(frame, rated.filter("doc_id < 600")).collect()}
    right = [(kind == "clean") == (i in kept) for i, _, kind in docs if i >= 600]
    assert np.mean(right) > 0.97
    again = quality.fit(frame.repartition(3), rated.filter("doc_id < 600"))
    assert again == model
    scored = quality.score(frame.drop("p_top"), model)
    assert scored.filter("expected_grade < 0 OR expected_grade > 2 OR p_top > expected_grade").count() == 0


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b", "s"), (2, None, "s"), (3, "", "s"), (1, "a b", "t")], "doc_id long, text string, _others string")
    kept = quality.select(docs, labels)  # one grade only: everything stays
    assert kept.columns == docs.columns and kept.count() == 4
    assert quality.select(docs.limit(0), labels.limit(0)).count() == 0


def test_gradient_of_the_likelihood_descends():
    loss = lambda w: (float(((w - 3) ** 2 * [1, 10]).sum()), 2 * (w - 3) * [1, 10])
    assert np.allclose(quality.descend(loss, np.zeros(2)), 3, atol=1e-3)


def goals(sizes, share=1.5, most=2):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    out, left, free = {}, share * sum(sizes.values()), list(names)
    while free:
        level = left / sum(weight[n] for n in free)
        full = [n for n in free if level * weight[n] >= most * sizes[n]]
        if not full:
            return out | {n: level * weight[n] for n in free}
        out |= {n: most * sizes[n] for n in full}
        left -= sum(out[n] for n in full)
        free = [n for n in free if n not in full]
    return out


def mixed_rows():
    names = ["a", "b", None, "é", "", "hot"]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else names[i % 6]
        rows.append((i, source, None if i % 17 == 0 else " ".join(["w\t"] * ((i * 7919) % 97)), "x", 1.0))
    return rows


@pytest.mark.parametrize("shuffled", [False, True])
def test_mix(spark, shuffled):
    rows = mixed_rows()
    if shuffled:
        random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, key string, u double")
    found = mixing.mixed(docs).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, _, t, _, _ in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    source = {r[0]: r[1] for r in rows}
    for i, n in size.items():
        sizes[source[i]] += n
    wanted = goals(sizes)
    for r in found:
        assert r.size == size[r.doc_id] and r.taken in (0, r.size, 2 * r.size)
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(wanted[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert len(found) == len(rows) and all(abs(taken[s] - wanted[s]) <= 30 for s in sizes)
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mixed(docs.repartition(3)).collect()))


def test_mix_edges(spark):
    schema = "doc_id long, source string, text string"
    docs = spark.createDataFrame([(1, "a", "x y z")] * 50 + [(None, "b", "p q")] * 20 + [(2, None, None), (3, "e", "")], schema)
    found = mixing.mixed(docs).collect()
    assert len(found) == 72 and all(r.taken <= 2 * r.size for r in found) and all(r.target == 0 for r in found if r.size == 0)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        docs = corpus_pipeline.materialise(docs, "test")
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    assert docs.filter("n_chars <> length(text)").count() == 0
    assert docs.filter("text RLIKE 'AKIA[A-Z0-9]{16}'").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == before
