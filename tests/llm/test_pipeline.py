"""The pipeline's stages, the registered queries and the entry file."""

import os
import random
import subprocess
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest
from compare import difference
from sentencepiece import SentencePieceProcessor
from tables import documents, prose
from test_mixing import size
from test_simhash import groups, plain_fingerprint

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm.pieces import MODEL

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
NAMES = [
    "op1_quality", "op2_url_filters", "op3_sentencepiece", "op4_substring_dedup", "op5_simhash", "op6_language_id",
    "op7_mixing", "op8_exact_dedup", "op9_neighbours", "op10_warc", "op11_secret_scan", "op12_vector_codes",
    "op13_collocations", "pipeline",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_all_are_registered():
    assert set(NAMES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(NAMES) & set(contract.oracle_sql())))
def test_query_matches_sql(spark, duck, name):
    assert difference(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name]) == ""


def rows(spark, table):
    return spark.read.parquet(f"{SF_DIR}/{table}.parquet").collect()


def test_quality_query(spark):
    found = {r.doc_id: r for r in contract.queries()["op1_quality"](spark, SF_DIR).collect()}
    assert set(found) == {r.doc_id for r in rows(spark, "documents")}
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in found.values())
    for held_out in (False, True):
        right = [found[r.doc_id].predicted == r.quality for r in rows(spark, "labels") if found[r.doc_id].held_out == held_out]
        assert len(right) > 20 and np.mean(right) > 0.9


def test_pieces_query(spark):
    library = SentencePieceProcessor(model_file=MODEL)
    found = contract.queries()["op3_sentencepiece"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in rows(spark, "documents")}
    assert len(found) == len(texts) and all(r.ids == library.encode(texts[r.doc_id]) and r.lossless for r in found)


def test_passages_query(spark):
    from test_passages import check

    found = contract.queries()["op4_substring_dedup"](spark, SF_DIR).collect()
    docs = [(r.doc_id, r.text) for r in rows(spark, "documents")]
    check(docs, found)
    # Exact copies of documents that are long enough are passages.
    bodies = {}
    for i, text in sorted(docs):
        bodies.setdefault(tuple(text.encode().lower().split()), []).append(i)
    copies = {i for words, ids in bodies.items() if len(words) >= 50 for i in ids[1:]}
    assert copies <= {r.doc_id for r in found}


def test_simhash_query(spark):
    docs = rows(spark, "documents")
    prints = [plain_fingerprint(r.text) for r in docs]
    labels = groups(prints)
    least = {label: min(r.doc_id for r, l in zip(docs, labels) if l == label) for label in set(labels)}
    want = Counter((r.doc_id, f"{p:016x}", least[l]) for r, p, l in zip(docs, prints, labels))
    assert Counter(map(tuple, contract.queries()["op5_simhash"](spark, SF_DIR).collect())) == want


def test_language_query(spark):
    found = contract.queries()["op6_language_id"](spark, SF_DIR).collect()
    assert len(found) == len(rows(spark, "pages")) and np.mean([r.language == r.declared for r in found]) > 0.95


def test_mixing_query(spark):
    found = contract.queries()["op7_mixing"](spark, SF_DIR).collect()
    docs = {r.doc_id: r for r in rows(spark, "documents")}
    targets, taken = {}, Counter()
    for r in found:
        assert r.size == size(docs[r.doc_id].text) and r.taken <= 2 * r.size
        targets[docs[r.doc_id].source] = r.target
        taken[docs[r.doc_id].source] += r.taken
    assert sum(targets.values()) == pytest.approx(1.5 * sum(r.size for r in found))
    assert all(abs(taken[s] - t) <= 1 for s, t in targets.items())


def test_neighbours_query(spark):
    found = contract.queries()["op9_neighbours"](spark, SF_DIR).collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows(spark, "embeddings")}
    hits = total = 0
    for q in (i for i in vectors if i % 100 == 0):
        best = sorted((float(np.linalg.norm(v - vectors[q])), i) for i, v in vectors.items() if i != q)[:10]
        mine = [r for r in found if r.query_id == q]
        hits += len({r.vec_id for r in mine} & {i for _, i in best})
        total += len(best)
        assert all(r.score == pytest.approx(float(np.linalg.norm(vectors[q] - vectors[r.vec_id])), rel=1e-12) for r in mine)
    assert hits >= 0.9 * total


def test_stages_one_by_one(spark):
    """Each stage against what its predecessor kept."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "sentencepiece",
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in rows(spark, "labels")}
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).checkpoint()
        kept.append(docs.collect())
        assert len(kept) == 5 or docs.columns == columns
    quality, exact, near, mix, last = kept
    good = [i for i, q in labels.items() if q == 1]
    assert len({r.doc_id for r in quality} & set(good)) > 0.9 * len(good)
    bodies = {}
    for r in quality:
        bodies.setdefault(r.text.encode().lower(), []).append(r.doc_id)
    assert Counter(r.doc_id for r in exact) == Counter(max(ids) for ids in bodies.values())
    labels = groups([plain_fingerprint(r.text) for r in exact])
    least = [min(r.doc_id for r, l in zip(exact, labels) if l == label) for label in set(labels)]
    assert Counter(r.doc_id for r in near) == Counter(least)
    words = sum(size(r.text) for r in near)
    assert abs(sum(size(r.text) for r in mix) - 1.5 * words) <= len({r.source for r in near})
    library = SentencePieceProcessor(model_file=MODEL)
    assert Counter((r.doc_id, tuple(library.encode(r.text))) for r in mix) == Counter((r.doc_id, tuple(r.ids)) for r in last)


def test_a_run_that_broke_off_goes_on_from_its_tables(spark, folder, monkeypatch):
    first = corpus_pipeline.run(spark, SF_DIR, folder + "/run").collect()
    assert sorted(os.listdir(folder + "/run")) == [
        "1_quality_classifier", "2_exact_dedup", "3_simhash_near_dedup", "4_mixing",
    ]

    def broken(*_):
        raise RuntimeError("not to be run again")

    stages = [(name, broken) for name, _ in corpus_pipeline.STAGES[:3]] + corpus_pipeline.STAGES[3:]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    os.remove(folder + "/run/4_mixing/_SUCCESS")
    again = corpus_pipeline.run(spark, SF_DIR, folder + "/run").collect()
    assert Counter(map(str, again)) == Counter(map(str, first))
    with pytest.raises(RuntimeError, match="again"):
        corpus_pipeline.run(spark, SF_DIR)


def test_awkward_tables_pass_through_all_stages(spark, folder):
    r = random.Random(1)
    odd = [(1, None), (2, ""), (None, "no id"), (3, "x" * 100_000), (3, "x" * 100_000), (4, prose(1, 50), None, None)]
    odd += [(100 + i, prose(i, r.randrange(5, 60))) for i in range(60)]
    labels = spark.createDataFrame([(100 + i, int(i % 12 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    for number, some in enumerate((odd, [])):
        documents(spark, some, extra=True).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            assert place == 4 or out.columns == docs.columns
            out.write.parquet(f"{folder}/{number}-{place}")
            docs = spark.read.parquet(f"{folder}/{number}-{place}")
        assert bool(some) == bool(docs.count())


def test_other_queries_do_without_this_subpackage():
    code = (
        "import sys\n"
        "sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and 'pipeline' not in e.queries() and 'op1_quality' not in e.oracle_sql()\n"
        "assert not any(m.startswith('tidemark.llm') for m in sys.modules)\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
