"""Helpers that several operators share: table reads, the query registry, checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.lake import work_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# A word: a run of anything but ASCII white space.  bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL to check it against where there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut: checkpointed in the folder that all executors share.

    ``spark.checkpoint.dir`` names it; only a session without one gets a folder of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


ARROW = {
    "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(),
    "string": pa.string(), "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def map_columns(
    df: DataFrame, function: Callable[..., Iterable], schema: str, *inputs: Column
) -> DataFrame:
    """``function`` gets one Arrow array per input column, batch by batch, and yields lists
    of output columns in the order of ``schema``, whose types are those of ARROW."""
    narrow = df.select(*(column.alias(f"c{i}") for i, column in enumerate(inputs)))
    names, kinds = zip(*(part.split() for part in schema.split(", ")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in function(*batch.columns):
                    yield pa.RecordBatch.from_arrays(
                        [as_arrow(c, ARROW[kind]) for c, kind in zip(columns, kinds)], list(names)
                    )

    return narrow.mapInArrow(run, schema)


def utf8(array: pa.Array) -> Iterator[bytes]:
    """The bytes of each text, null as empty, without decoding them."""
    for value in array.cast(pa.binary()):
        yield value.as_py() or b""


def row_key() -> Column:
    """What tells the rows of ``documents`` apart: id and text.  Rows equal in both are
    interchangeable."""
    return F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string")
    )


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose :func:`row_key` is in ``keys`` (one column ``row_key``), one
    row per key.  Texts move once, to the partition of their key; repeated rows are dropped
    by each map task before that."""
    key = fresh(docs, "row_key")
    return (
        docs.withColumn(key, row_key())
        .dropDuplicates([key])
        .join(keys.select(F.col("row_key").alias(key)), key, "left_semi")
        .select(*docs.columns)
    )


class BitFilter:
    """A set of 64-bit hashes as bits of a table of fixed size: what it holds is said to be held,
    other hashes are by chance.  None of it, if the set is empty."""

    def __init__(self, words: np.ndarray | None, bits: int):
        self.words, self.bits = words, bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """For hashes as uint64."""
        if self.words is None:
            return np.zeros(len(hashes), dtype=bool)
        at = hashes >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def bit_filter(hashed: DataFrame, name: str, bits: int = 25) -> BitFilter:
    """The filter of a column of 64-bit hashes; 2^bits bits at most reach the driver."""
    at = F.shiftrightunsigned(F.col(name), 64 - bits)
    rows = hashed.where(F.col(name).isNotNull()).select(at.alias("at")).selectExpr(
        "shiftrightunsigned(at, 6) AS place", "shiftleft(1L, CAST(at & 63 AS INT)) AS mask"
    )
    table = rows.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    if not table.num_rows:
        return BitFilter(None, bits)
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[table["place"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return BitFilter(words, bits)


def uniform(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1."""
    return hashed.cast("double") / 2.0**64 + 0.5


def hash_sample(df: DataFrame, total: int, most: int, hashed: Column) -> DataFrame:
    """``most`` rows with the smallest hashes, of ``total``: tasks drop what cannot be among
    them before anything is put in one place."""
    likely = uniform(hashed) < F.lit(1.5 * most / max(total, 1))
    return df.where(likely).orderBy(hashed).limit(most)


def shingle_hashes(words: list[bytes], size: int, seed: int = 42) -> np.ndarray | None:
    """XXH64 of every ``size`` words joined by spaces; None if there are fewer words."""
    if len(words) < size:
        return None
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    one = xxhash.xxh64_intdigest
    return np.array([one(joined[a : z - 1], seed) for a, z in zip([0, *ends], ends[size - 1 :])], dtype="<u8")
