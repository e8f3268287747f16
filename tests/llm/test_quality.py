import random
import zlib

import numpy as np
import pytest
from tables import awkward, documents, prose

from tidemark.llm import quality as op

LABELS = "doc_id long, quality int, toxic int"


def junk(seed):
    words = prose(seed, 60).split()
    return [" ".join(w for w in words[:3] for _ in range(20)), " ".join(w.upper() + "!!" for w in words),
            " | ".join(words), " ".join(w + "***" for w in words)][seed % 4]


def corpus(n=400):
    rows = [(i, junk(i) if i % 5 == 0 else prose(i, 40 + i % 50).capitalize() + ".") for i in range(n)]
    labels = [(i, 0 if i % 5 == 0 else 1, 0) for i in range(n)]
    return rows, labels


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    labels += [(None, 1, 0), (3, None, 0), (4, 7, 0), (5, 0, 1)]
    docs = documents(spark, rows + [(1000 + i, r[1]) for i, r in enumerate(awkward())], extra=True)
    model = op.train(docs, spark.createDataFrame(labels, LABELS))
    found = op.scored(docs, model, "it").where("doc_id < 1000").select("doc_id", "it").collect()
    right = [(r.it >= op.ACCEPT) == (r.doc_id % 5 != 0) for r in found if held(r.doc_id)]
    assert len(right) > 80 and np.mean(right) > 0.97
    assert all(0 <= r.it <= 1 for r in op.scored(docs, model, "it").select("it").collect())


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, labels = corpus()
    wrong = [(i, 1 - q if held(i) else q, t) for i, q, t in labels]
    docs = documents(spark, rows)
    one = op.train(docs, spark.createDataFrame(labels, LABELS))
    two = op.train(docs, spark.createDataFrame(wrong, LABELS))
    assert (one.weight == two.weight).all() and one.shift == two.shift
    flags = docs.select("doc_id", op.held_out(docs["doc_id"]).alias("h")).collect()
    assert all(r.h == held(r.doc_id) for r in flags)


def test_the_lists_to_fit_on_are_bounded_in_bytes(spark):
    rows, labels = corpus(200)
    docs, labels = documents(spark, rows + [(200, prose(1, 50_000))]), spark.createDataFrame(labels + [(200, 1, 0)], LABELS)
    whole, part = op.train(docs, labels), op.train(docs, labels, fit_bytes=20_000)
    assert part.weight.shape == whole.weight.shape and (part.weight != whole.weight).any()
    none = op.train(docs, labels, fit_bytes=0)
    assert {r.score for r in op.scored(docs, none).collect()} == {none.score(np.empty(0, dtype=np.int32))}


def test_filter_keeps_columns_and_clean_rows(spark):
    rows, labels = corpus()
    docs = documents(spark, rows, extra=True)
    kept = op.quality_filter(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & {i for i in range(400) if i % 5}) > 310 and len(ids & set(range(0, 400, 5))) < 4


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0), (3, 1, 0)]])
def test_without_both_classes_scores_are_the_share(spark, labels):
    docs = documents(spark, [(1, "a"), (2, None), (3, "b c")])
    model = op.train(docs, spark.createDataFrame(labels, LABELS))
    ones = sum(not held(i) for i, _, _ in labels)
    scores = [r.score for r in op.scored(docs, model).collect()]
    assert scores == pytest.approx([(ones + 1) / (ones + 2)] * 3)
    assert op.scored(documents(spark, []), model).count() == 0


def test_descent_reaches_the_best_hinge_loss():
    r = random.Random(1)
    rows = [np.array(sorted(r.sample(range(30), 6)), dtype=np.int32) for _ in range(80)]
    values = [np.array([r.gauss(0, 1) for _ in row]) for row in rows]
    labels = np.array([int(v.sum() + 0.3 * row.mean() > 4.5) for v, row in zip(values, rows)])
    sign = np.where(labels == 1, 1, -1)
    dense = np.zeros((80, 31))
    for i, (row, value) in enumerate(zip(rows, values)):
        dense[i, row], dense[i, 30] = value, 1

    def loss(w):
        return 0.5 * w @ w + 2.0 * np.maximum(0, 1 - sign * (dense @ w)).sum()

    weight, bias = op.dual_coordinate_descent(rows, values, labels, 2.0, 2000)
    reached = np.append(weight[:30], bias)
    best = min(
        (loss(reached * scale + np.random.default_rng(s).normal(0, size, 31)) for s in range(200)
         for scale, size in ((1, 0.01), (1, 0.1), (0.9, 0.05), (1.1, 0.05))),
    )
    assert loss(reached) <= best + 1e-6


def test_features_of_long_texts_do_not_depend_on_slabs(monkeypatch):
    text = prose(1, 5000).encode()
    whole = op.Features()(text)
    monkeypatch.setattr(op, "SLAB", 1000)
    assert (op.Features()(text) == whole).all()
    assert len(op.Features()(b"")) == 0
