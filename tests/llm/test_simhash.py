import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from tables import awkward, documents, prose

from tidemark.llm import simhash as op


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, radius=2):
    """Component of each point, by comparing all pairs."""
    label = list(range(len(points)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    return [root(i) for i in range(len(points))]


@pytest.mark.parametrize("extra", [False, True])
def test_components_match_brute_force(spark, extra):
    texts = [prose(i, 200, 50) for i in range(30)]
    rows = awkward() + [(200 + i, t) for i, t in enumerate(texts)]
    rows += [(300 + i, t.replace("w7 ", "W7\t") + " tail") for i, t in enumerate(texts)]
    prints = [plain_fingerprint(r[1]) for r in rows]
    labels = groups(prints)
    want = Counter()
    for row, value, label in zip(rows, prints, labels):
        ids = [r[0] for r, other in zip(rows, labels) if other == label and r[0] is not None]
        want[(row[0], value, min(ids) if ids else None)] += 1
    got = op.near_duplicates(documents(spark, rows, extra))
    assert Counter((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got.collect()) == want


def test_spark_hashes_shingles_alike(spark):
    assert spark.sql("SELECT xxhash64('a b c') AS h").first().h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("shard", [40, 4096])
def test_links_connect_what_all_pairs_connect(spark, shard):
    r = random.Random(5)
    points = [r.getrandbits(64) for _ in range(300)]
    for base in points[:60]:  # chains of neighbours, so that components span shards
        for _ in range(4):
            for _ in range(r.randrange(3)):
                base ^= 1 << r.randrange(64)
            points.append(base)
    points = sorted(set(points))
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in points], "fingerprint long")
    pairs = op.links(frame, shard=shard).collect()
    assert all(((a ^ b) % 2**64).bit_count() <= 2 * len(points) for a, b in pairs)
    roots = {row.node % 2**64: row.root % 2**64 for row in op.components(op.links(frame, shard=shard)).collect()}
    label = groups(points)
    want = {}
    for p, l in zip(points, label):
        want.setdefault(l, set()).add(p)
    got = {}
    for p in points:
        got.setdefault(roots.get(p, p), set()).add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_a_group_too_dense_to_part_is_not_gathered(spark):
    r = random.Random(9)
    centre = r.getrandbits(64)
    ball = {centre}
    while len(ball) < 1500:  # most of them four bits apart: no vantage parts them
        a, b = r.sample(range(64), 2)
        ball.add(centre ^ (1 << a) ^ (1 << b))
    ball = set(r.sample(sorted(ball - {centre}), 1400))
    points = sorted(ball | {r.getrandbits(64) for _ in range(300)})
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in points], "fingerprint long")
    tree = op.grow(np.array(points, dtype=np.uint64), 2, 8, 100)
    assert op.DENSE_LEAF in str(tree)
    found = op.links(frame, shard=20)
    largest = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in largest
    roots = {row.node % 2**64: row.root % 2**64 for row in op.components(found).collect()}
    want, got = {}, {}
    for p, l in zip(points, groups(points)):
        want.setdefault(l, set()).add(p)
        got.setdefault(roots.get(p, p), set()).add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_dense_points_link_alike(monkeypatch):
    r = np.random.default_rng(2)
    points = np.unique(np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (700, 3)).astype(np.uint64), axis=1))
    rows, home = np.arange(len(points)), np.ones(len(points), dtype=bool)
    plain, dense = op.Forest(len(points)), op.Forest(len(points))
    op.link_leaf(points, rows, home, 2, plain)
    op.link_dense(points, rows, 2, dense)
    monkeypatch.setattr(op, "LEAF", 20)
    tree = op.Forest(len(points))
    op.link(points, rows, home, 2, tree)
    assert (plain.label == dense.label).all() and (plain.label == tree.label).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    roots = {r.node: r.root for r in op.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {199: 199, 200: 199}
    assert roots == want


def test_one_row_of_each_component_stays(spark):
    rows = awkward()
    docs = documents(spark, rows, extra=True)
    kept = op.simhash_dedup(docs)
    assert kept.columns == docs.columns
    label = groups([plain_fingerprint(r[1]) for r in rows])
    assert kept.count() == len(set(label))
    assert op.simhash_dedup(documents(spark, [])).count() == 0
    assert op.near_duplicates(documents(spark, [])).count() == 0
