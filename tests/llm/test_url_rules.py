import random
import re
from collections import Counter

import pytest

from tidemark.llm import url_rules as op


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")


def judged(url, rules):
    host, path = split(url)
    best = None
    for h, p, v in rules:
        if h and p is not None and host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h) + len(p), len(h), h + p, v))
    return (url, host, path, best[2] if best else None, best[3] if best else "allow")


def urls():
    r = random.Random(2)
    hosts = ["org", "a.org", "b.a.org", "xa.org", "com", "a.com", ".a.com", "A.B.a.COM", "é.a.org", "a..org", "org.", "a.org:80"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/ab", "/é/a", "/a%20b", "//", "/a\x01", "/a\U0010ffff"]
    out = [None, "", "no scheme", "http://", "://", "http:///a/b", "mailto:x@a.org", "http://a.org?x=/a", "http://a.org#/a"]
    out += [f"http{r.choice(['', 's'])}://{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '?q=://x/', '#f', '\nline'])}" for _ in range(400)]
    long = "/a" * 20_000
    return out + ["http://a.org/a/b"] * 50 + [f"http://{'x.' * 5_000}b.a.org{long}?{long}", f"http://a.org{long}"]


@pytest.mark.parametrize("slice_rows", [3, 1024])
def test_verdicts_match_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(op, "SLICE", slice_rows)
    r = random.Random(3)
    hosts = ["org", "a.org", "b.a.org", "com", "a.com", "net", "é.a.org", "org."]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/é"]
    rules = sorted({(r.choice(hosts), r.choice(paths)): r.choice(["allow", "block"]) for _ in range(30)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    odd = rules + [(None, "/", "block"), ("", "/", "block"), ("org", None, "block"), rules[0]]
    frame = spark.createDataFrame([(u, "x", "y") for u in urls()], "url string, host string, rule string")
    got = op.judge(frame, spark.createDataFrame(odd, "host string, path string, verdict string"))
    assert sorted(got.columns) == ["host", "path", "rule", "url", "verdict"]
    found = Counter(tuple(row) for row in got.select("url", "host", "path", "rule", "verdict").collect())
    assert found == Counter(judged(u, rules) for u in urls())


def test_a_hot_suffix_is_swept_in_slices(spark, monkeypatch):
    """No task gets more than a few slices of a group that holds all hosts."""
    monkeypatch.setattr(op, "SLICE", 200)
    hosts = spark.range(8_000).selectExpr(
        "'com' AS group", "struct(concat(id, '.com') AS host) AS point", "cast(hex(concat(id, 'x')) AS binary) AS key"
    )
    rules = spark.range(5).selectExpr(
        "'com' AS group", "struct(concat(id, '.com') AS host) AS interval", "cast(hex(cast(id AS string)) AS binary) AS key"
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = op.enclosing(hosts, rules)
        tasks = [n for n in found.rdd.glom().map(len).collect() if n]
        assert sum(tasks) == found.count() > 2_000
        assert len(tasks) > 6 and max(tasks) < sum(tasks) / 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_block_wins_between_equal_rules_and_the_default_is_the_callers(spark):
    frame = spark.createDataFrame([("http://a.org/x",), ("http://b.net/",)], "url string")
    rules = spark.createDataFrame([("a.org", "/", "allow"), ("A.org", "/", "block")], "host string, path string, verdict string")
    got = {row.url: (row.rule, row.verdict) for row in op.judge(frame, rules, default="block").collect()}
    assert got == {"http://a.org/x": ("a.org/", "block"), "http://b.net/": (None, "block")}


def test_empty_tables(spark):
    rules = spark.createDataFrame([("a.org", "/", "allow")], "host string, path string, verdict string")
    nothing = spark.createDataFrame([], "url string")
    assert op.judge(nothing, rules).count() == 0
    one = spark.createDataFrame([("http://a.org/x",)], "url string")
    assert [tuple(r) for r in op.judge(one, rules.limit(0)).collect()] == [("http://a.org/x", "a.org", "/x", None, "allow")]


def test_plan_runs_no_python(spark):
    rules = spark.createDataFrame([("a.org", "/", "allow")], "host string, path string, verdict string")
    frame = spark.range(10).selectExpr("concat('http://a.org/', id) AS url")
    plan = op.judge(frame, rules)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
