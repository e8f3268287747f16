import hashlib
from collections import Counter, defaultdict

import pytest
from tables import awkward, documents, prose

from tidemark.llm import exact_dedup as op


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").encode().lower()].append(row)
    out = Counter()
    for body, members in groups.items():
        ids = [m[0] for m in members if m[0] is not None]
        keep = max(ids) if ids else None
        for i, member in enumerate(sorted(members, key=lambda m: (m[0] is None, -(m[0] or 0), str(m[1])))):
            out[(member[0], keep, len(members), i == 0, hashlib.sha256(body).hexdigest())] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


@pytest.mark.parametrize("extra", [False, True])
def test_groups_match_brute_force(spark, extra):
    rows = awkward() + [(100 + i, prose(i % 7, 30)) for i in range(40)]
    assert found(op.duplicates(documents(spark, rows, extra))) == expected(rows)


def test_texts_whose_chunks_share_digests_are_told_apart(spark):
    rows = [(i, prose(i // 2, 2000)) for i in range(12)] + awkward()
    assert found(op.duplicates(documents(spark, rows), digest_bytes=1)) == expected(rows)


def test_empty_table(spark):
    assert op.duplicates(documents(spark, [])).count() == 0
    assert op.exact_dedup(documents(spark, [])).count() == 0


def test_one_row_of_each_group_stays_whole(spark):
    rows = awkward()
    docs = documents(spark, rows, extra=True)
    kept = op.exact_dedup(docs)
    assert kept.columns == docs.columns
    bodies = Counter((r.text or "").encode().lower() for r in kept.collect())
    assert set(bodies.values()) == {1}
    assert set(bodies) == {(r[1] or "").encode().lower() for r in rows}
    assert {r.doc_id for r in kept.where("text like 'w%' AND length(text) > 1000").collect()} == {9, 10}


def test_chunks_join_to_the_text_and_follow_its_content():
    data = prose(3, 200_000).encode()
    parts = list(op.chunks(data))
    assert b"".join(parts) == data
    assert max(map(len, parts)) <= op.LONGEST
    assert min(map(len, parts[:-1])) >= op.SHORTEST
    shifted = set(op.chunks(b"some words put before " + data))
    assert len(shifted & set(parts)) > 0.95 * len(parts)
    assert list(op.chunks(b"")) == []
