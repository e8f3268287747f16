"""Exact dedup through recipes of content-defined chunks.

Every text (A-Z lower-cased, UTF-8) is cut where a rolling hash of the last 16 bytes says so.
Chunks are deduplicated to identifiers that stand for one content each, and texts are equal
where their ordered lists of identifiers are.  Texts leave their scan once, as chunks that
each map task has deduplicated; grouping and keeping move lists of identifiers only.

Defined cases: null counts as empty; all empty texts form one group.  Of rows with equal text
the one with the largest doc_id stays, null being smallest; of rows tied in it exactly one.
Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import keep_rows, map_columns, query, read, row_key, utf8, written

WINDOW, SLAB = 16, 1 << 20
AVERAGE_BITS, SHORTEST, LONGEST = 11, 512, 16384
GEAR = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=4).digest(), "little") for i in range(256)],
    dtype=np.uint32,
)


def marks(data: bytes) -> Iterator[int]:
    """Ends of chunks that the content suggests: where the top bits of the hash are zero."""
    for start in range(0, len(data), SLAB):
        first = max(0, start - WINDOW + 1)
        value = GEAR[np.frombuffer(data[first : start + SLAB], dtype=np.uint8)]
        for shift in (1, 2, 4, 8):
            value[shift:] += value[:-shift] << np.uint32(shift)
        hits = np.flatnonzero(value >> np.uint32(32 - AVERAGE_BITS) == 0) + first + 1
        yield from hits[hits > start].tolist()


def chunks(data: bytes) -> Iterator[bytes]:
    """``data`` in chunks of SHORTEST to LONGEST bytes (the last may be shorter)."""
    start = 0
    if len(data) > SHORTEST:
        for end in marks(data):
            while end - start > LONGEST:
                yield data[start : start + LONGEST]
                start += LONGEST
            if end - start >= SHORTEST:
                yield data[start:end]
                start = end
    while start < len(data):
        yield data[start : start + LONGEST]
        start += LONGEST


def _digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def clashes(docs: DataFrame, digest_bytes: int) -> DataFrame:
    """(digest, chunk, variant) for digests that stand for more than one chunk."""

    def distinct(texts):
        seen = {}
        for text in utf8(texts):
            for chunk in chunks(text.lower()):
                seen[chunk] = None
        yield [[_digest(chunk, digest_bytes) for chunk in seen], list(seen)]

    all_chunks = map_columns(docs, distinct, "digest binary, chunk binary", F.col("text")).distinct()
    variants = all_chunks.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    unsafe = written(variants.select("digest"))
    if unsafe.isEmpty():
        return unsafe.withColumns({"chunk": F.lit(b""), "variant": F.lit(0)}).limit(0)
    listed = all_chunks.join(unsafe, "digest").groupBy("digest").agg(
        F.sort_array(F.collect_list("chunk")).alias("chunks")
    )
    return written(listed.select("digest", F.posexplode("chunks").alias("variant", "chunk")))


def recipes(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """One row per document: doc_id, row_key, text_sha256 and the recipe, its chunks'
    identifiers in order.  An identifier is a digest, with a variant number where a digest
    stands for several chunks."""

    def cut(ids, keys, texts):
        bodies = [text.lower() for text in utf8(texts)]
        lists = [b"".join(_digest(c, digest_bytes) for c in chunks(body)) for body in bodies]
        yield [ids, keys, [hashlib.sha256(body).hexdigest() for body in bodies], lists]

    schema = "doc_id long, row_key string, text_sha256 string, recipe binary"
    inputs = [F.col("doc_id").cast("long"), row_key(), F.col("text")]
    told_apart = clashes(docs, digest_bytes)
    if told_apart.isEmpty():
        return written(map_columns(docs, cut, schema, *inputs))

    def pieces(rows, ids, keys, texts):
        for row, doc, key, text in zip(rows.to_pylist(), ids.to_pylist(), keys.to_pylist(), utf8(texts)):
            body = text.lower()
            found = list(chunks(body)) or [b""]
            yield [
                [row] * len(found), [doc] * len(found), [key] * len(found),
                [hashlib.sha256(body).hexdigest()] * len(found), range(len(found)),
                [_digest(c, digest_bytes) if c else b"" for c in found], found,
            ]

    parts = map_columns(
        docs, pieces,
        "row long, doc_id long, row_key string, text_sha256 string, place long, digest binary, chunk binary",
        F.monotonically_increasing_id(), *inputs,
    )
    named = parts.join(told_apart, ["digest", "chunk"], "left").withColumn(
        "id", F.concat("digest", F.lpad(F.coalesce("variant", F.lit(0)).cast("string"), 8, "0").cast("binary"))
    )
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("place", "id"))), lambda x: x["id"])
    whole = named.groupBy("row", "doc_id", "row_key", "text_sha256").agg(
        F.aggregate(ordered, F.lit(b""), lambda a, b: F.concat(a, b)).alias("recipe")
    )
    return written(whole.drop("row"))


def duplicates(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, digest_bytes).groupBy("doc_id", "row_key", "text_sha256", "recipe").agg(
        F.count("*").alias("copies")
    )
    groups = rows.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "row_key")).alias("keep"), F.sum("copies").alias("group_size")
    )
    # Written, so that the join below can split the partition of a large group.
    groups = written(groups)
    stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("row_key") == F.col("keep.row_key"))
    return (
        rows.join(groups, "recipe")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "doc_id", "row_key", F.col("keep.doc_id").alias("keep_id"), "group_size",
            (stays & (F.col("copy") == 1)).alias("kept"), "text_sha256",
        )
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    return keep_rows(docs, duplicates(docs).where("kept"))


@query(
    "op8_exact_dedup",
    """
    WITH n AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS body
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
    FROM n WINDOW g AS (PARTITION BY body)
    """,
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(read(spark, sf_dir, "documents")).drop("row_key")
