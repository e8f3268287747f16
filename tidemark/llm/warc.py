"""WARC archives: written from pages, read back by following record lengths.

Writing is one text sink whose rows are records and whose line separator is the blank line
that ends a record, so archives are plain files on whatever file system the path names.
Of records with equal payloads one is a response, the others revisit it.

Reading cuts the files at every ``WARC/1.0`` line, wherever the splits of a file fall.  Each
cut is a candidate record; its Content-Length gives the offset of its successor.  Offsets are
prefix sums of the pieces' lengths, first within a split, then over the splits.  A payload may
hold the magic line itself, so only candidates that can be reached from the start of their
file are records: tasks follow the chains within a split, and pointer jumping from split to
split doubles the steps of a chain in every round.  Payloads cut
by a rejected candidate are put together again.

Defined cases: a null html is an empty payload.  Rows that tie in the largest page_id of
their payload are all responses; a null page_id is smaller than any.  A null url gives a
record without target; line ends in an url are escaped.  Repeated rows are written and read
as often as they come, extra columns are not read, and an empty table gives no records.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import query, read, written
from tidemark.operators.publish import discard
from tidemark.sources.lake import work_folder

MAGIC, END = "WARC/1.0\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BUCKETS = 1 << 20  # of 16 bytes each, broadcast
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: each 5 hexadecimal digits are 4 digits of 5 bits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One text per row of ``pages``: a record without the blank line that ends it."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumns({"same": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    groups = rows.where(F.col("bytes") >= least_bytes).groupBy("same").agg(
        F.max("page_id").alias("response_id"), F.count("*").alias("n")
    )
    groups = written(groups.where("n > 1").drop("n"))
    # Pages whose payload falls into no bucket of a repeated one stay where they are read.
    bucket = lambda: F.pmod(F.xxhash64("same"), F.lit(BUCKETS))
    buckets = groups.select(bucket().alias("bucket"), F.lit(True).alias("repeats")).distinct()
    rows = rows.withColumn("bucket", bucket()).join(F.broadcast(buckets), "bucket", "left").drop("bucket")
    alone = rows.where("repeats IS NULL").withColumn("response_id", F.lit(None).cast("long"))
    rows = alone.unionByName(rows.where("repeats").join(groups, "same", "left"))
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    name = lambda column: F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(END),
    )
    line = lambda field, value: F.concat(F.lit(f"{field}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(
            revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("response_id"))))
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line(
            "Content-Length",
            (F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))).cast("string"),
        ),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    return rows.select(F.concat(header, http, body).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    records(pages, least_bytes).write.option("lineSep", END).text(path)


def cuts(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magic lines: file (a hash of its path), the start of the split it
    was read in, a number that orders the cuts of a split, and the text."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        "value",
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """The headers of what stands after each magic line, up to the next, with its file and
    offset, and the size and digest of its payload if the next magic line is beyond it."""
    pieces = cuts(spark, path).withColumn("bytes", F.octet_length("value").cast("long"))
    sizes = pieces.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("all"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    begins = written(sizes.select("file", "block", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("begin")))
    head = F.substring_index("value", END, 1)
    two = F.substring_index("value", END, 2)
    said_bytes = F.regexp_extract(two, r"(?im)^Content-Length: *(\d+)[\s\S]*^Content-Length: *(\d+)", 2)
    field = lambda name: F.regexp_extract(head, rf"(?im)^{name}: *([^\r\n]*?) *\r?$", 1)
    body = F.octet_length(two) + len(END)
    length = F.expr("try_cast(length_text AS long)")
    payload = F.expr("substring(cast(value AS binary), body + 1, greatest(length - (body - block_begin), 0))")
    parsed = pieces.withColumns({
        "length_text": field("Content-Length"),
        "block_begin": F.octet_length(head) + len(END),
        "body": body,
    }).withColumn("length", length)
    whole = F.col("block_begin") + F.col("length") <= F.col("bytes")
    parsed = parsed.select(
        "file", "block", "nth", "bytes", "length", "block_begin",
        field("WARC-Type").alias("type"),
        field("WARC-Record-ID").alias("id"),
        F.nullif(field("WARC-Refers-To"), F.lit("")).alias("refers"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("said_digest"),
        whole.alias("whole"),
        # A revisit's own payload is left out; its HTTP headers tell the size.
        F.when(
            field("WARC-Type") == "revisit",
            said_bytes.try_cast("long"),
        ).when(whole, F.octet_length(payload).cast("long")).alias("payload_bytes"),
        F.when(whole & (field("WARC-Type") != "revisit"), base32_sha1(payload)).alias("payload_digest"),
    )
    within = W.partitionBy("file", "block").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)
    placed = parsed.withColumn("sum", F.sum(F.col("bytes") + len(MAGIC)).over(within)).join(begins, ["file", "block"])
    # A piece ends where the next magic line begins; it stands after its own.
    start = F.col("begin") + F.col("sum") - F.col("bytes") - 2 * len(MAGIC)
    return written(
        placed.withColumn("offset", start).where("offset >= 0").drop("sum", "begin").withColumn(
            "next",
            F.when(
                F.col("block_begin") <= F.col("bytes"),
                F.col("offset") + len(MAGIC) + F.col("block_begin") + F.col("length") + len(END),
            ),
        )
    )


def reachable(steps: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain from offset 0 of their file; ``steps`` has
    file, offset and next.  After round k the first 2^k of each chain are known."""
    steps = steps.where("next > offset").select("file", "offset", "next")
    known = steps.where("offset = 0").select("file", "offset")
    count = -1
    while (now := known.count()) != count:
        count = now
        jump = steps.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        reached = known.join(steps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        known = written(known.union(reached).distinct())
        steps = written(steps.join(jump, ["file", "next"]).select("file", "offset", F.col("after").alias("next")))
    return known


def _exits(table: pa.Table) -> pa.Table:
    """Where the chain from each candidate of a split leaves the split."""
    offsets, nexts = table["offset"].to_pylist(), table["next"].to_pylist()
    leaves: dict[int, int] = {}
    for offset, after in sorted(zip(offsets, nexts), reverse=True):
        leaves[offset] = leaves.get(after, after)
    return pa.table({
        "file": table["file"], "block": table["block"], "offset": table["offset"],
        "next": pa.array([leaves[offset] for offset in offsets], type=pa.int64()),
    })


def _walk(table: pa.Table) -> pa.Table:
    """The candidates of a split on the chains from its entries."""
    step = dict(zip(table["offset"].to_pylist(), table["next"].to_pylist()))
    reached = set()
    for offset, entry in zip(table["offset"].to_pylist(), table["entry"].to_pylist()):
        while entry and offset in step and offset not in reached:
            reached.add(offset)
            offset = step[offset]
    return pa.table({
        "file": pa.array([table["file"][0].as_py()] * len(reached), type=pa.int64()),
        "offset": pa.array(sorted(reached), type=pa.int64()),
    })


def on_chain(found: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that are records: each split's chains are followed
    within the split, pointers jump from split to split, and the splits' entries that the
    file's start reaches are followed once more."""
    steps = written(found.where("next > offset").select("file", "block", "offset", "next"))
    exits = written(steps.groupBy("file", "block").applyInArrow(_exits, "file long, block long, offset long, next long"))
    starts = steps.where("offset = 0").select("file", "offset")
    entries = exits.select("file", F.col("next").alias("offset")).union(starts).distinct()
    known = reachable(exits.join(entries, ["file", "offset"], "left_semi"))
    marked = steps.join(known.withColumn("entry", F.lit(True)), ["file", "offset"], "left")
    return marked.withColumn("entry", F.coalesce("entry", F.lit(False))).groupBy("file", "block").applyInArrow(
        _walk, "file long, offset long"
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: id, type, refers, payload_bytes and payload_digest.  Of a response
    both are computed from what was read, of a revisit taken from its headers."""
    found = candidates(spark, path)
    kept = found.join(on_chain(found), ["file", "offset"])
    simple = kept.where("whole")
    split = written(kept.where("NOT whole").select("file", "offset", "next", "id", "type", "refers", "said_digest"))
    columns = ["id", "type", "refers", "said_digest", "payload_bytes", "payload_digest"]
    if not split.isEmpty():
        simple = simple.select(columns).union(rejoined(spark, path, found, split).select(columns))
    revisit = F.col("type") == "revisit"
    return simple.select(
        "id", "type", "refers", "payload_bytes",
        F.when(revisit, F.col("said_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        (revisit | (F.col("said_digest") == F.col("payload_digest"))).alias("intact"),
    )


def rejoined(spark: SparkSession, path: str, found: DataFrame, split: DataFrame) -> DataFrame:
    """The records whose payload holds magic lines, with their pieces put together."""
    files = split.select("file").distinct()
    owner = F.last(F.col("next"), ignorenulls=True).over(
        W.partitionBy("file").orderBy("offset").rowsBetween(W.unboundedPreceding, 0)
    )
    first = F.last(F.when(F.col("next").isNotNull(), F.col("offset")), ignorenulls=True).over(
        W.partitionBy("file").orderBy("offset").rowsBetween(W.unboundedPreceding, 0)
    )
    places = found.select("file", "block", "nth", "offset").join(files, "file", "left_semi")
    parts = (
        places.join(split.select("file", "offset", "next"), ["file", "offset"], "left")
        .withColumns({"until": owner, "record": first})
        .where("offset < until")
        .select("file", "block", "nth", "offset", "record")
    )
    values = cuts(spark, path)
    # The pieces of one record, in order, with the magic lines between them.
    whole = values.join(parts, ["file", "block", "nth"]).groupBy("file", "record").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]), MAGIC
        ).alias("value")
    )
    joined = split.join(whole, (split["file"] == whole["file"]) & (split["offset"] == whole["record"]))
    body = F.octet_length(F.substring_index("value", END, 2)) + len(END)
    payload = F.expr(f"substring(cast(value AS binary), body + 1, next - offset - {len(MAGIC) + len(END)} - body)")
    return joined.withColumn("body", body).select(
        split["file"], "offset", "id", "type", "refers", "said_digest",
        F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"),
    )


def page_number(name: str) -> Column:
    return F.expr(f"try_cast(regexp_extract({name}, '<urn:page:(-?[0-9]+)>', 1) AS long)")


@query(
    "op10_warc",
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keep,
               row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) = 1 AS first,
               sha1(coalesce(html, '')) AS digest
        FROM pages
    )
    SELECT page_id, strlen(payload) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(digest, 5 * (i // 4)::BIGINT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1)), '')
               AS payload_digest,
           CASE WHEN first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN NOT first THEN keep END AS refers_to
    FROM p
    """,
)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/warc-{uuid.uuid4().hex}"
    try:
        write_archives(read(spark, sf_dir, "pages"), path)
        return written(read_archives(spark, path).select(
            page_number("id").alias("page_id"), "payload_bytes", "payload_digest",
            F.col("type").alias("record_type"), page_number("refers").alias("refers_to"),
        ))
    finally:
        discard(spark, path)
