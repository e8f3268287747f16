import math
import random

import duckdb
import pytest
from compare import difference

from tidemark.llm import vector_codes as v
from tidemark.llm.common import ORACLE

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error, label) and the entries, with Python's integers."""
    kept = [
        (i, [math.floor(x * scale) for x in e], label)
        for i, e, label in rows
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda x, p: x[p * width : (p + 1) * width]
    books = [[cut(x, p) for _, x, _ in kept[:entries]] for p in range(parts)]

    def near(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(x, p), entry)), n) for n, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, x, _ in kept:
                members.setdefault(near(x, p)[1], []).append(cut(x, p))
            books[p] = [
                [sum(c) // len(members[n]) for c in zip(*members[n])] if n in members else entry
                for n, entry in enumerate(books[p])
            ]
    out = []
    for i, x, label in kept:
        found = [near(x, p) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), label))
    return out, books


def vectors(n, width, seed=1, spread=1.0):
    r = random.Random(seed)
    return [(i * 7 % 1009, [r.gauss(0, spread) for _ in range(width)], r.choice([None, 0, 1, 2])) for i in range(n)]


def single(spark, rows):
    """As the table has them: in single precision."""
    return spark.createDataFrame(rows, SCHEMA), [
        (i, None if e is None else [x if x is None else spark_float(x) for x in e], label) for i, e, label in rows
    ]


def spark_float(x):
    return float(v.np.float32(x))


AWKWARD = [
    (1, None, 1), (2, [1.0, None] * 4, 1), (3, [NAN] * 8, 1), (4, [INF] + [0.0] * 7, None), (5, [0.0] * 8, None),
    (None, [0.5] * 8, 3), (None, [0.5] * 8, 3), (7, [-0.0004] * 8, 3), (7, [-0.0004] * 8, 3), (-9, [-3.25] * 8, None),
    (2**62, [60_000.0] * 8, 4),
]


@pytest.mark.parametrize(("rows", "entries"), [
    (vectors(120, 8), 16), (vectors(40, 8) + AWKWARD, 16), (AWKWARD, 256), (vectors(30, 12, spread=40.0), 256),
])
def test_codes_equal_those_of_plain_integers(spark, rows, entries):
    table, exact = single(spark, rows)
    codes, books = v.compress(table.selectExpr("*", "'x' AS code", "1 AS error", "2 AS ids"), entries=entries)
    got = sorted(((r.vec_id, r.code, r.error, r.label) for r in codes.collect()), key=str)
    wanted, entries_ = brute(exact, entries=entries)
    assert got == sorted(((i, c, e, None if l is None else str(l)) for i, c, e, l in wanted), key=str)
    assert [books.part(p).tolist() for p in range(4)] == entries_
    code = wanted[0][1]
    assert books.decode(code) == [x for p in range(4) for x in entries_[p][int(code[2 * p : 2 * p + 2], 16)]]


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rows = vectors(90, 8, seed=3)
    table, _ = single(spark, rows)
    usable = v.usable(table.repartition(3)).collect()
    data = v.np.array([r.vector for r in usable])
    books = v.Codebooks(v.integers(data[:10]), [0, 2, 4, 6, 8])

    def of(block):
        found = [v.np.unique(c, return_inverse=True) for c in v.integers(block).T]
        return books.nearest([x for x, _ in found], v.np.array([c for _, c in found], dtype=v.np.uint16))

    whole, errors = of(data)
    monkeypatch.setattr(v, "STEP", 7)
    parts = [of(data[i : i + 31]) for i in range(0, 90, 31)]
    assert (whole == v.np.concatenate([n for n, _ in parts])).all()
    assert (errors == v.np.concatenate([e for _, e in parts])).all()


def test_query_matches_sql(spark, tmp_path):
    rows = vectors(400, 16, seed=2, spread=0.2) + [(2000, None, 1), (2001, [NAN] * 16, None)]
    table, _ = single(spark, rows)
    table.repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert difference(v.op12_vector_codes(spark, str(tmp_path)), duck, ORACLE["op12_vector_codes"]) == ""


def test_label_errors_of_a_hot_label(spark, tmp_path):
    rows = [(i, e, None if i % 3 else 1) for i, e, _ in vectors(150, 8)]
    table, exact = single(spark, rows)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    wanted, books = brute(exact)
    sums = {}
    for _, _, error, label in wanted:
        sums[label] = sums.get(label, 0) + error
    digest = v.hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    got = v.op12_vector_codes(spark, str(tmp_path)).collect()
    assert sorted(r.label_error for r in got) == sorted(sums[label] for *_, label in wanted)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_an_empty_table_and_other_lengths(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert v.op12_vector_codes(spark, str(tmp_path)).collect() == []
    table = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [3.0], 0), (3, [4.0, 5.0], 0), (4, [], 0)], SCHEMA)
    codes, books = v.compress(table)
    assert {r.vec_id for r in codes.collect()} == {1, 3} and books.entries.shape == (2, 2)
    codes, _ = v.compress(spark.createDataFrame([(1, [], 0)], SCHEMA))
    assert [(r.code, r.error) for r in codes.collect()] == [("00000000", 0)]


def test_components_too_large_for_exact_distances_are_refused():
    with pytest.raises(ValueError, match="beyond"):
        v.integers(v.np.array([[1e30]]))
