import random
from collections import defaultdict

import numpy as np
import pytest
from tables import awkward, documents

from tidemark.llm import language as op

SOUNDS = {"en": ["the", "ing", "and", "sh"], "de": ["sch", "ung", "ein", "ver"], "fr": ["eau", "que", "ou", "les"]}


def text(seed, language, words=40):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SOUNDS[language]) for _ in range(r.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text(i, list(SOUNDS)[i % 3]), list(SOUNDS)[i % 3]) for i in range(60)]
    return documents(spark, rows + [(None, "x", "en"), (900, None, "en"), (901, "y", None), (902, "z", "")], extra=True)


def pages():
    rows = []
    for i in range(120):
        language = list(SOUNDS)[i % 3]
        host = f"{'www.' if i % 2 else ''}site{i % 5}.example.{ {'en': 'com', 'de': 'de', 'fr': 'fr'}[language] }"
        said = ["", f' lang="{language}"', " lang='en-GB'", " lang=xx"][i % 4]
        body = text(1000 + i, language) if i % 6 else ""
        rows.append((i, f"https://{host}/{i}", f"<html{said}><script>the the the</script><p>{body}</p></html>"))
    rows += [(500, None, None), (501, "no url", ""), (None, "http://www.site1.example.de/x", "<p>eau</p>"), (3, rows[3][1], rows[3][2])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS lang", "'y' AS host")


def fused(rows, languages, model):
    """The fusion, row by row, without Spark."""
    import re

    from test_url_rules import split

    seen = []
    for page, url, html in rows:
        host = split(url)[0]
        found = re.search(r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]+)", html or "")
        name = found[1].lower() if found else "none"
        name = name if name in [*languages, "none"] else "other"
        scores = op.text_evidence(model, (html or "").encode())
        own = np.rint(op.softmax(scores) * op.UNIT) / op.UNIT
        seen.append((page, host, name, scores, own))
    sums, names = defaultdict(lambda: np.zeros(len(languages))), [*languages, "other", "none"]
    for _, host, name, _, own in seen:
        for key in ((3, host), (2, ".".join(host.split(".")[-2:])), (1, host.split(".")[-1]), (0,), ("said", name)):
            sums[key] = sums[key] + own
    says = np.array([sums[("said", n)] for n in names]).T.copy()
    says[:, : len(languages)] += op.KAPPA * np.eye(len(languages))
    says = np.log((says + 0.1) / (says + 0.1).sum(axis=1, keepdims=True))
    for page, host, name, scores, own in seen:
        levels = [sums[(1, host.split(".")[-1])], sums[(2, ".".join(host.split(".")[-2:]))], sums[(3, host)]]
        share = sums[(0,)] - own + 1 / len(own)
        share = share / share.sum()
        for counts in levels:
            left = np.maximum(counts - own, 0)
            share = (left + op.KAPPA * share) / (left.sum() + op.KAPPA)
        post = op.softmax(scores + says[:, names.index(name)] + np.log(share))
        yield page, host, name, languages[int(np.argmax(post))], float(post.max())


def test_fusion_matches_brute_force(spark, docs):
    languages, model = op.train(docs)
    assert languages == sorted(SOUNDS)
    got = [tuple(r) for r in op.identify(frame(spark, pages()), docs).collect()]
    want = list(fused(pages(), languages, model))
    order = lambda row: (str(row[0]), row[1])
    for one, two in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert one[:4] == two[:4] and one[4] == pytest.approx(two[4], abs=1e-9)
    right = [r[3] == list(SOUNDS)[r[0] % 3] for r in got if r[0] is not None and r[0] < 120]
    assert np.mean(right) > 0.97


def test_pages_without_text_lean_on_markup_and_address(spark, docs):
    got = {r.page_id: r.language for r in op.identify(frame(spark, pages()), docs).collect()}
    silent = [i for i in range(0, 120, 6)]
    assert np.mean([got[i] == list(SOUNDS)[i % 3] for i in silent]) > 0.8


def test_a_very_long_page(spark, docs):
    page = "<html><!--" + "x" * 300_000 + "-->" + "<p>" + text(5, "de", 60_000) + "</p>" * 50_000
    rows = [(1, "http://a.b.example.com/" + "y" * 100_000, page), (2, "http://a.b.example.com/", None)]
    got = {r.page_id: (r.language, r.host) for r in op.identify(frame(spark, rows), docs).collect()}
    assert got[1] == ("de", "a.b.example.com") and set(got) == {1, 2}


def test_without_labelled_documents_or_pages(spark, docs):
    nothing = documents(spark, [(1, "x", None)])
    got = op.identify(frame(spark, pages()[:3]), nothing)
    assert {(r.language, r.probability) for r in got.collect()} == {(None, None)} and got.count() == 3
    assert op.identify(frame(spark, []), docs).count() == 0
    assert op.identify(frame(spark, [(1, "http://a.de/", "<p>x</p>")]), documents(spark, awkward())).count() == 1


def test_page_text_drops_markup():
    html = b"<!-- a > b --><style>p{}</style><P>One<br>two</p><script>var t='</p>';</SCRIPT > three"
    assert op.page_text(html) == b"one two three"
