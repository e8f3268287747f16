import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from compare import difference
from tables import awkward, documents

from tidemark.llm import collocations as c
from tidemark.llm.common import ORACLE


def lowered(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")


def brute(rows, longest=3, least=10, share=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for row in rows:
        lang = "und" if len(row) > 2 and row[2] is None else row[2] if len(row) > 2 else "en"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(row[1])):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        rows = []
        for p, a in candidates.items():
            best = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * n >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, n in candidates.items() if len(q) > len(p)
            )
            if not inside:
                rows.append((-best[0], -a, " ".join(p).encode(), f[p[: best[1]]], f[p[best[1] :]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, texts=60, words=60):
    """Skewed words, set phrases, marks and odd blanks, in three languages and none."""
    r = random.Random(seed)
    names = [f"w{i}" for i in range(40)] + ["É", "日本", "x\x1fy", "(a", "a)"]
    rows = []
    for doc in range(texts):
        parts = []
        for _ in range(words):
            pick = r.random()
            if pick < 0.15:
                parts.append(r.choice(["New York City", "new YORK", "as well as", "a b a b a b"]))
            else:
                parts.append(names[min(int(r.expovariate(0.15)), len(names) - 1)])
            parts.append(r.choice([" "] * 12 + ["\t", "  ", ", ", ".", "\n", "!? ", " "]))
        rows.append((doc, "".join(parts), r.choice(["en", "en", "de", None])))
    return rows


# The second and third have most words, then most phrases, without ranks; the last has a
# filter of few bits that lets others through.
LIMITS = [{}, {"words_most": 6, "phrases_most": 5}, {"words_most": 1000, "phrases_most": 3},
          {"words_most": 1, "phrases_most": 1, "filter_bits": 7}]


@pytest.mark.parametrize("limits", LIMITS)
def test_phrases_equal_those_counted_one_by_one(spark, limits):
    rows = corpus(1)
    assert result(c.collocations(documents(spark, rows, extra=True), **limits)) == brute(rows)


@pytest.mark.parametrize("limits", LIMITS[:2])
def test_longer_phrases_and_other_settings(spark, limits):
    rows = corpus(2, texts=40)
    got = result(c.collocations(documents(spark, rows), longest=5, least=4, share=80, top=30, **limits))
    assert got == brute(rows, longest=5, least=4, share=80, top=30)


def test_awkward_rows(spark):
    rows = awkward() + [(50 + i, "tied pair. other pair! " * 3, lang) for i in range(4) for lang in ("und", None)]
    rows += [(90, "no, phrase; at: all " * 20 + "w" * 100 + " long " + "w" * 100, "it")]
    assert result(c.collocations(documents(spark, rows, extra=True))) == brute(rows)


def test_an_empty_table(spark):
    assert c.collocations(documents(spark, [])).collect() == []
    assert c.collocations(documents(spark, [(1, None), (2, " ,. ")])).collect() == []


def test_tiles():
    r = np.random.default_rng(3)
    left = np.concatenate([r.integers(0, 200, 30_000), r.integers(0, 5_000, 4_000)])
    right = np.concatenate([r.integers(0, 256, 30_000), r.integers(0, 70_000, 4_000)])
    a, b, n = c.pair_counts(left, right)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == Counter(zip(left.tolist(), right.tolist()))
    assert len(a) == len(set(zip(a.tolist(), b.tolist())))


def test_scores_beyond_64_bits(spark):
    row = spark.sql("SELECT 9000000000000 AS a, 9000000000001 AS l, 9000000000007 AS r")
    a, l, r = 9000000000000, 9000000000001, 9000000000007
    assert row.select(c.exact_score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (l * r)


def test_query_matches_sql(spark, tmp_path):
    documents(spark, corpus(4, texts=80)).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(c.op13_collocations(spark, str(tmp_path)), duck, ORACLE["op13_collocations"]) == ""
