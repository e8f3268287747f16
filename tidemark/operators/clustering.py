"""Proofs about clustered tables from per-file facts: spans that do not overlap, unique keys.

What is known of a file (or a run of its rows) is one small row; the rows of the table are
read where they lie and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.landing import quoted
from tidemark.operators.quality import grain_gate

SPAN_CUTS = 256


def file_spans(df: DataFrame, key: str) -> DataFrame:
    """One row per file that ``df`` reads: file, rows, and the first and last key in it.

    Reads one column; tasks send one row per file.
    """
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.min(quoted(key)).alias("first"), F.max(quoted(key)).alias("last")
    )


def reached(spans: DataFrame) -> DataFrame:
    """``spans`` (first, last, and others that tell them apart) with ``reach``: the largest last
    key of the spans before it in the order of first keys.

    A sorted sweep in parts: spans are dealt by cut points of a sample of first keys, reach
    is a running maximum within a part, and what a part begins with is the maximum of the
    parts before it, of which there are SPAN_CUTS or so.  ``spans`` must be a written table,
    since it is read several times.
    """
    names = [c for c in spans.columns if c not in ("first", "last")]
    known = spans.filter(F.col("first").isNotNull())
    every = max(1, known.count() // SPAN_CUTS)
    sample = known.filter(F.pmod(F.xxhash64("first", *names), F.lit(every)) == 0) if every > 1 else known.limit(0)
    cuts = [row["first"] for row in sample.select("first").distinct().orderBy("first").limit(4 * SPAN_CUTS).collect()]
    kind = spans.schema["first"].dataType
    part: Column = reduce(
        Column.__add__, [(F.col("first") >= F.lit(cut).cast(kind)).cast("int") for cut in cuts], F.lit(0)
    )
    parted = known.withColumn("__part", part)
    tops = parted.groupBy("__part").agg(F.max("last").alias("__top"))
    # A row per part.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("__part", F.max("__top").over(before).alias("__base"))
    within = Window.partitionBy("__part").orderBy("first", "last", *names).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parted.join(F.broadcast(tops), "__part")
        .withColumn("reach", F.greatest(F.max("last").over(within), F.col("__base")))
        .drop("__part", "__base")
    )


def overlap_report(spans: DataFrame) -> DataFrame:
    """One row: files, rows, the span of all, and how many files begin before an earlier one
    ends.  Files may share the key at their border."""
    found = reached(spans)
    return found.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.count_if(F.col("first") < F.col("reach")).alias("overlapping"),
    )


def key_runs(df: DataFrame, key: str) -> DataFrame:
    """One row per stretch of rows that a task reads from a file: file, start (row number),
    rows, known (non-NULL keys), changes (keys that differ from the one before, the first
    included), in_order, first and last key.

    ``df`` reads Parquet files.  Every task sends as many rows as it reads files.
    """
    kind = df.schema[key].dataType
    rows = df.select(
        quoted(key).alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    schema = T.StructType.fromDDL("file string, start bigint, rows bigint, known bigint, changes bigint, in_order boolean")
    schema = T.StructType([*schema.fields, T.StructField("first", kind), T.StructField("last", kind)])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            begin = 0
            files, at = batch.column(1), batch.column(2).to_numpy()
            while begin < batch.num_rows:
                # As far as rows of one file follow each other.
                same = pc.equal(files[begin:], files[begin]).to_numpy(zero_copy_only=False)
                follow = same & (at[begin:] - at[begin] == range(batch.num_rows - begin))
                size = len(follow) if follow.all() else int(follow.argmin())
                part = batch.column(0).slice(begin, size)
                here = facts(part)
                start, file = int(at[begin]), files[begin].as_py()
                if held and held["file"] == file and held["start"] + held["rows"] == start:
                    held = joined(held, here)
                else:
                    if held:
                        yield row(held, batch.schema.field(0).type)
                    held = {"file": file, "start": start, **here}
                begin += size
        if held:
            yield row(held, batch.schema.field(0).type)

    def facts(keys: pa.Array) -> dict:
        known = keys.drop_null()
        n = len(known)
        if not n:
            return {"rows": len(keys), "known": 0, "changes": 0, "in_order": True, "first": None, "last": None}
        before, after = known.slice(0, n - 1), known.slice(1)
        return {
            "rows": len(keys), "known": n, "changes": 1 + (pc.sum(pc.not_equal(before, after)).as_py() or 0),
            "in_order": pc.all(pc.less_equal(before, after)).as_py() is not False, "first": known[0], "last": known[n - 1],
        }

    def joined(a: dict, b: dict) -> dict:
        out = {**a, "rows": a["rows"] + b["rows"], "known": a["known"] + b["known"]}
        if not b["known"]:
            return out
        if not a["known"]:
            return {**out, "changes": b["changes"], "in_order": b["in_order"], "first": b["first"], "last": b["last"]}
        out["changes"] = a["changes"] + b["changes"] - pc.equal(a["last"], b["first"]).as_py()
        out["in_order"] = a["in_order"] and b["in_order"] and pc.less_equal(a["last"], b["first"]).as_py()
        return {**out, "last": b["last"]}

    def row(run: dict, key_type: pa.DataType) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), key_type, key_type]
        names = ["file", "start", "rows", "known", "changes", "in_order", "first", "last"]
        values = [v.as_py() if isinstance(v := run[name], pa.Scalar) else v for name in names]
        return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, types)], names)

    return rows.mapInArrow(runs, schema)


def clustered_grain_gate(df: DataFrame, runs: DataFrame, key: str) -> DataFrame:
    """:func:`quality.grain_gate` of a table whose :func:`key_runs` were written to ``runs``.

    Where rows are sorted within files and files hold spans that at most touch, equal keys
    are neighbours, so distinct keys are counted from changes within runs and at their
    borders; the table itself is not read again.  Any other table is checked by its distinct
    keys.
    """
    found = reached(runs.select("file", "start", "rows", "changes", "in_order", "first", "last")).agg(
        F.coalesce(F.sum("changes"), F.lit(0)).alias("changes"),
        F.count_if(F.col("first") == F.col("reach")).alias("shared"),
        F.count_if(~F.col("in_order") | (F.col("first") < F.col("reach"))).alias("astray"),
    ).first()
    if found["astray"]:
        return grain_gate(df, key)
    totals = runs.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"))
    counts = totals.withColumn("distinct_keys", F.lit(found["changes"] - found["shared"]).cast("bigint"))
    return counts.withColumn("passed", F.col("total_rows") == F.col("distinct_keys"))
