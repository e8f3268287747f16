import base64
import hashlib
import re
from collections import Counter

import pytest

from tidemark.llm import warc as op

FAKE = (
    "a\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    "WARC/1.0\r\nx"
)


def pages():
    rows = [(i, f"http://x/{i}\r\nEvil: 1", FAKE * (i % 5) + str(i % 7) * (i % 60) if i % 11 else None) for i in range(150)]
    rows += [(None, None, "q"), (None, "u", "q"), (5, "u", ""), (7, None, "WARC/1.0\r\n"), (8, "é", "é\r\n\r\n😀")]
    return rows + [(900, "z", "z" * 300_000), (901, "z", "z" * 300_000), (901, "z", "z" * 300_000), (902, "tail", FAKE[:60])]


def expected(rows, least=0):
    by = {}
    for i, _, html in rows:
        by.setdefault(html or "", []).append(i)
    out = Counter()
    for i, _, html in rows:
        payload = (html or "").encode()
        keep = max((x for x in by[html or ""] if x is not None), default=None)
        keep = keep if len(payload) >= least and len(by[html or ""]) > 1 else i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = ("response", None) if i == keep else ("revisit", keep)
        out[(i, len(payload), digest, *kind, True)] += 1
    return out


def archived(spark, frame, path, least=0):
    op.write_archives(frame, path, least)
    found = op.read_archives(spark, path)
    return Counter(
        tuple(r) for r in found.select(
            op.page_number("id"), "payload_bytes", "payload_digest", "type", op.page_number("refers"), "intact"
        ).collect()
    )


@pytest.mark.parametrize(("split", "least"), [("900", 0), ("64m", 0), ("5000", 100)])
def test_what_was_written_is_read(spark, folder, split, least):
    frame = spark.createDataFrame(pages(), "page_id long, url string, html string").selectExpr("*", "'x' AS value", "1 AS bytes")
    old = [(k, spark.conf.get(k)) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        assert archived(spark, frame.repartition(3), f"{folder}/w", least) == expected(pages(), least)
    finally:
        for key, value in old:
            spark.conf.set(key, value)


def test_empty_table(spark, folder):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert archived(spark, frame, f"{folder}/w") == Counter()


def test_records_have_the_form_of_the_standard(spark, folder):
    frame = spark.createDataFrame([(1, "http://a/", "one"), (2, None, "one")], "page_id long, url string, html string")
    op.write_archives(frame.coalesce(1), f"{folder}/w")
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(f"{folder}/w/*.txt").collect())
    seen = []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.0" and rest[length : length + 4] == b"\r\n\r\n"
        seen.append((fields["WARC-Type"], fields.get("WARC-Refers-To"), rest[:length].partition(b"\r\n\r\n")[2]))
        raw = rest[length + 4 :]
    assert sorted(seen, key=str) == [("response", None, b"one"), ("revisit", "<urn:page:2>", b"")]


def test_chains_from_the_start_only(spark):
    steps = [("f", i * 10, i * 10 + 10) for i in range(37)] + [("f", 55, 65), ("f", 65, 70), ("g", 5, 9), ("g", 0, None), ("h", 0, 9)]
    frame = spark.createDataFrame(steps, "file string, offset long, next long")
    got = {tuple(r) for r in op.reachable(frame).collect()}
    assert {(f, o) for f, o in got if o < 370} >= {("f", i * 10) for i in range(37)}
    assert not got & {("f", 55), ("f", 65), ("g", 5)}
    blocks = frame.selectExpr("file", "offset", "next", "int(offset / 60) * 60 AS block")
    longs = blocks.selectExpr("xxhash64(file) AS file", "bigint(block) AS block", "offset", "next")
    names = {r.h: r.file for r in frame.selectExpr("file", "xxhash64(file) AS h").distinct().collect()}
    chain = {(names[f], o) for f, o in op.on_chain(longs).collect()}
    assert chain == {("f", i * 10) for i in range(37)} | {("h", 0)}


def test_base32(spark):
    row = spark.range(1).select(op.base32_sha1(op.F.lit("abc")).alias("d")).first()
    assert row.d == base64.b32encode(hashlib.sha1(b"abc").digest()).decode() and re.fullmatch("[A-Z2-7]{32}", row.d)
