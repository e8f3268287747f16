import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import neighbours as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, extra=False):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return df.selectExpr("*", "'x' AS vector", "1 AS ids", "2 AS shard", "3 AS score") if extra else df


def clustered(n, length=16, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, length))
    return [(int(i), (centres[i % 8] + 0.3 * r.normal(size=length)).astype(np.float32).tolist()) for i in range(n)]


def brute(rows, queries, k=10):
    out = {}
    for q, x in queries:
        found = sorted((math.dist(x, v), i) for i, v in rows if i != q)
        out[q] = found[:k]
    return out


def searched(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("slab", [16384, 60])
def test_recall_and_scores(spark, monkeypatch, slab):
    monkeypatch.setattr(op, "SHARD", 200)
    monkeypatch.setattr(op, "SLAB", slab)
    monkeypatch.setattr(op, "QUERY_BLOCK", 7)
    rows = clustered(2000)
    frame = table(spark, rows, extra=True)
    got = searched(op.nearest(frame, frame.where("vec_id % 100 = 0")))
    want = brute(rows, [r for r in rows if r[0] % 100 == 0])
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    vectors = dict(rows)
    for q, found in got.items():
        assert all(s == pytest.approx(math.dist(vectors[q], vectors[i]), rel=1e-12) for s, i in found)
        assert found == sorted(found)


def test_ties_copies_and_odd_rows(spark):
    point = [1.0, 0.0, 2.0]
    rows = [(i, point) for i in range(0, 400)] + [(1000 + i, [1.0, 0.0, 2.0 + i]) for i in range(1, 30)]
    odd = [
        (5000, None), (5100, [0.0, 0.0, 0.0]), (5200, [1.0, None, 2.0]), (5300, [1.0, float("nan"), 2.0]),
        (5400, [1.0, float("inf"), 2.0]), (5500, [1.0, 2.0]), (5600, []), (None, point), (7, point), (100, point),
    ]
    frame = table(spark, rows + odd)
    got = searched(op.nearest(frame, frame.where("vec_id % 100 = 0")))
    want = brute(rows, [r for r in rows if r[0] % 100 == 0])
    assert got == {q: [(pytest.approx(s), i) for s, i in found] for q, found in want.items()}


def test_few_candidates_and_empty_tables(spark):
    frame = table(spark, [(0, [1.0, 1.0]), (1, [2.0, 2.0]), (100, [1.0, 2.0])])
    got = searched(op.nearest(frame, frame.where("vec_id % 100 = 0")))
    assert {q: [i for _, i in v] for q, v in got.items()} == {0: [100, 1], 100: [0, 1]}
    nothing = table(spark, [])
    assert op.nearest(nothing, nothing).count() == 0
    assert op.nearest(frame, nothing).count() == 0


def test_quantile_of_the_stopping_test():
    draws = np.square(np.random.default_rng(1).normal(size=(200_000, op.DIMENSIONS))).sum(axis=1)
    for sure in (0.5, 0.9, 0.97):
        assert (draws < op.chi_square_quantile(sure)).mean() == pytest.approx(sure, abs=0.005)


def test_boxes_hold_their_points():
    points = np.random.default_rng(2).normal(size=(500, op.DIMENSIONS))
    tree = op.grow(points, 4)
    corners = {leaf: (low, high) for leaf, low, high in op.boxes(tree)}
    for point, leaf in zip(points, op.leaf_of(tree, points)):
        assert op.box_distance(point, *corners[leaf]) == 0
    assert Counter(len(rows) <= op.LEAF for rows in op.leaves(points)) == {True: len(op.leaves(points))}
