import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tables import awkward, documents, prose

from tidemark.llm import pieces as op


@pytest.fixture(scope="module")
def words():
    return op.vocabulary()


@pytest.fixture(scope="module")
def encoder(words):
    return op.Encoder(words)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=op.MODEL)


PARTS = [*"aeth1.,()=_-/'\"#AZéß日😀\x00\n\t", " ", " ", "  ", "the", "ing", "ab", "//", "U.S.", "e.g.", "http://x.org/a_b?c=1"]


def ids(encoder, text):
    return np.frombuffer(encoder(text), dtype=np.int32).tolist()


def test_ids_are_those_of_the_library(encoder, library):
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice(PARTS) for _ in range(r.randrange(60)))
        assert ids(encoder, text) == library.encode(text), repr(text)


@pytest.mark.parametrize("unit", ["a", " ", "=", "日", "\n", "aehti", "ab ", "…", "▁"])
def test_runs_without_breaks(encoder, library, unit):
    for n in (1, 2, 3, 7, 16, 17, 40, 255, 256, 257, 1000):
        assert ids(encoder, unit * n) == library.encode(unit * n)


def test_a_long_stretch_needs_a_short_window(encoder, library, monkeypatch):
    r = random.Random(4)
    text = "".join(r.choice("aehtinors") for _ in range(5000))
    longest = []
    plain = op.Encoder.commit
    monkeypatch.setattr(op.Encoder, "commit", lambda self, s, *a: (longest.append(len(s)), plain(self, s, *a))[1])
    encoder.memory.clear()
    assert ids(encoder, text) == library.encode(text)
    assert len(longest) > 10 and max(longest) < 2 * op.CHECK_EVERY


def test_memory_is_bounded(words, library, monkeypatch):
    monkeypatch.setattr(op, "MEMORY", 5)
    monkeypatch.setattr(op, "PAIRS", 5)
    encoder = op.Encoder(words)
    for seed in range(20):
        assert ids(encoder, prose(seed, 20)) == library.encode(prose(seed, 20))


def test_round_trip_of_awkward_rows(spark, library):
    rows = awkward() + [(50, "with ▁ mark")]
    docs = documents(spark, rows, extra=True)
    found = op.encode(docs).collect()
    assert len(found) == len(rows)
    want = sorted((str(r[0]), library.encode(r[1] or "")) for r in rows)
    assert sorted((str(r.doc_id), r.ids) for r in found) == want
    assert all(r.n_ids == len(r.ids) for r in found)
    assert [r.doc_id for r in found if not r.lossless] == [50]
    back = sorted((str(r.doc_id), r.text) for r in op.decode(op.encode(docs)).collect())
    assert back == sorted((str(r[0]), (r[1] or "").replace("▁", " ")) for r in rows)
    assert op.encode(documents(spark, [])).count() == 0
