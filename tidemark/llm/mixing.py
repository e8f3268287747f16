"""Mixing sources to target weights by a low-discrepancy schedule.

Documents of a source are put in the order of a hash of their id, end to end, and cut into
blocks of equally many words.  Golden-ratio points, mapped through the cumulative weights of
the sources, say which source each slot of the mix takes a block from; the rank of a slot
among those of its source says which block, starting over after the last.  Slots beyond a
source's target are void and handed to sources that the points left short, at the end.  The
order of the points is the order of the mix: :func:`mix_order` gives its blocks by position,
and what is taken of a document is counted from the same rows.

No source is gathered in one task: order and ranks are prefix sums, first within hash ranges
or chunks of slots, then over their totals.  Per source the driver sees two numbers.

Defined cases: a null text has size 0.  Rows without source form a source of their own, the
last.  Documents of size 0 are returned and nothing is taken of them.  Rows without doc_id
come in one fixed place of their source; repeated rows count each.  Without words all
targets are 0; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, fresh, map_columns, query, read, row_key, written

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2  # words of the mix per word of the input; times a word may be taken
BLOCK = 1024
CHUNK = 1 << 16  # slots per row of the schedule
BUCKETS, BUCKETS_MOST = 10, 20  # bits of the hash that cut a source into ranges
RANGE_BITS = 16  # a range is planned for so many rows at most, as a power of two
SOURCES_MOST = 1_000_000  # 16 bytes each reach the driver and every task
GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio


def water_fill(sizes: np.ndarray, weights: np.ndarray, share: float = SHARE, most: int = MOST) -> np.ndarray:
    """Targets by weight, none above ``most`` times its size; what is above is shared again."""
    target = np.zeros(len(sizes))
    rest, free = share * sizes.sum(), sizes > 0
    while free.any() and rest > 0:
        level = rest / weights[free].sum()
        full = free & (level * weights >= most * sizes)
        if not full.any():
            target[free] = level * weights[free]
            break
        target[full] = most * sizes[full]
        rest -= target[full].sum()
        free &= ~full
    return target


def slots_needed(sizes: np.ndarray, targets: np.ndarray, block: int) -> np.ndarray:
    """Blocks to take so that each source reaches its target (rounded down to words)."""
    words = np.floor(targets + 1e-6).astype(np.int64)
    size = np.maximum(sizes, 1)
    return words // size * -(-sizes // block) + -(-(words % size) // block)


def schedule(spark: SparkSession, needed: np.ndarray, chunk: int = CHUNK) -> DataFrame:
    """(rank, slot, position): as many slots as ``needed`` for each source, numbered from 0, in
    the order of the mix: the number of the point, or, of slots that the points left out, one
    after all points."""
    total = int(needed.sum())
    bounds = np.cumsum(needed)
    # The first point of the next source, in 64-bit steps of the circle.
    edges = np.array(
        [min((int(b) << 64) // max(total, 1), 2**64 - 1) for b in bounds[:-1]], dtype=np.uint64
    )

    def sources_of(number: int) -> np.ndarray:
        first = number * chunk
        points = np.arange(first, min(first + chunk, total), dtype=np.uint64) * GOLDEN
        return np.searchsorted(edges, points, side="right")

    def counted(numbers):
        for number in numbers.to_pylist():
            found, counts = np.unique(sources_of(number), return_counts=True)
            yield [np.full(len(found), number), found, counts]

    def placed(numbers, ranks, offsets):
        for number, rank, offset in zip(numbers.to_pylist(), ranks.to_pylist(), offsets.to_pylist()):
            sources = sources_of(number)
            order = np.argsort(sources, kind="stable")
            first = np.searchsorted(sources[order], rank)
            within = np.empty(len(sources), dtype=np.int64)
            counts = np.diff([*first, len(sources)])
            within[order] = np.arange(len(sources)) + np.repeat(np.array(offset) - first, counts)
            valid = within < needed[sources]
            yield [sources[valid], within[valid], number * chunk + np.flatnonzero(valid)]

    chunks = spark.range(-(-total // chunk))
    counts = written(map_columns(chunks, counted, "chunk long, rank long, n long", F.col("id")))
    before = W.partitionBy("rank").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    listed = offsets.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("rank", "offset"))).alias("l"))
    regular = map_columns(
        listed, placed, "rank long, slot long, position long", F.col("chunk"), F.col("l.rank"), F.col("l.offset")
    )
    got = {row["rank"]: row["n"] for row in counts.groupBy("rank").agg(F.sum("n").alias("n")).collect()}
    short, after = [], total
    for i, n in enumerate(needed.tolist()):
        if got.get(i, 0) < n:
            short.append((i, got.get(i, 0), n, after - got.get(i, 0)))
            after += n - got.get(i, 0)
    late = spark.createDataFrame(short, "rank long, low long, high long, shift long").select(
        "rank", F.explode(F.sequence("low", F.col("high") - 1)).alias("slot"), "shift"
    )
    return regular.union(late.select("rank", "slot", F.col("slot") + F.col("shift")))


def arranged(
    docs: DataFrame, weights: tuple[int, ...], block: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows to mix, words per source and hash range, the sources with their targets, and
    the turns: position, rank, block, its length and how much of it is taken."""
    spark = docs.sparkSession
    ordered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key().alias("row_key"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t")).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col("doc_id").cast("long"), F.lit("mix")).alias("place"),
    )
    ordered = written(ordered)
    # Ranges are cut by the first bits of the place, which rows are ordered by: how many bits
    # does not change what is taken.
    bits = min(BUCKETS_MOST, max(BUCKETS, ordered.count().bit_length() - RANGE_BITS))
    ordered = ordered.withColumn("bucket", F.shiftright("place", 64 - bits))

    # Sources in code point order, the one without name last: "s..." sorts before "t".
    ranges = ordered.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    ranges = written(ranges)
    sources = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = written(sources.withColumn("rank", F.row_number().over(W.orderBy("source")) - 1))
    if sources.count() > SOURCES_MOST:
        raise ValueError(f"more than {SOURCES_MOST} sources to weigh")
    sizes = np.array(
        [row["source_size"] for row in sources.select("rank", "source_size").orderBy("rank").collect()],
        dtype=np.int64,
    )
    targets = water_fill(sizes, np.resize(np.array(weights, dtype=float), len(sizes)))
    needed = slots_needed(sizes, targets, block)
    goals = spark.createDataFrame(
        [(i, float(t), int(t + 1e-6)) for i, t in enumerate(targets)], "rank int, target double, words long"
    )
    sources = sources.join(goals, "rank")

    # How often each block is taken whole, and how far the last, cut one goes.
    blocks = F.greatest(F.ceil(F.col("source_size") / block), F.lit(1))
    epoch, number = F.floor(F.col("slot") / blocks), F.col("slot") % blocks
    begun = epoch * F.col("source_size") + number * block
    length = F.least(F.lit(block), F.col("source_size") - number * block)
    left = F.col("words") - begun
    turns = schedule(spark, needed).join(sources, "rank").select(
        "position", "rank", "source", number.alias("block"), length.alias("length"), F.least(length, left).alias("take")
    )
    return ordered, ranges, sources, turns


def mix_order(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """The mix as a sequence of blocks: position (ascending, with gaps), source, block (of the
    source's words in hash order) and words taken of it."""
    _, _, _, turns = arranged(docs, weights, block)
    named = F.when(F.col("source") != "t", F.substring("source", 2, 2**31 - 1))
    return turns.select("position", named.alias("source"), "block", F.col("take").alias("words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, size, source_size, target, taken."""
    ordered, ranges, sources, turns = arranged(docs, weights, block)
    plays = turns.groupBy("rank", "block").agg(
        F.sum((F.col("take") >= F.col("length")).cast("long")).alias("whole"),
        F.max(F.when(F.col("take") < F.col("length"), F.col("take"))).alias("part"),
    )

    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).join(sources, "source")
    within = W.partitionBy("source", "bucket").orderBy("place", "doc_id", "row_key", "size")
    rows = (
        ordered.withColumn("nth", F.row_number().over(within))
        .withColumn("start", F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
        .join(offsets.drop("words"), ["source", "bucket"])
        .withColumn("start", F.col("start") + F.col("offset"))
    )
    end = F.col("start") + F.col("size")
    touched = F.when(
        F.col("size") > 0,
        F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block)),
    )
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(end - F.col("block") * block, F.lit(block))
    words = F.coalesce("whole", F.lit(0)) * (high - low) + F.greatest(
        F.least(high, F.coalesce("part", F.lit(0))) - low, F.lit(0)
    )
    identity = ["rank", "bucket", "nth", "doc_id", "row_key", "size", "source_size", "target"]
    return (
        rows.withColumn("block", F.explode_outer(touched))
        .join(plays, ["rank", "block"], "left")
        .groupBy(*identity)
        .agg(F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("taken"))
        .select("doc_id", "row_key", "size", "source_size", "target", "taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, as often as it takes them; where it takes a part of one, a row
    with its first words."""
    key, size, taken, words = (fresh(docs, name) for name in ("row_key", "size", "taken", "words"))
    # Rows equal in id and text are interchangeable, so their counts may be added up.
    counts = mix(docs).where("taken > 0").groupBy(F.col("row_key").alias(key), F.col("size").alias(size)).agg(
        F.sum("taken").alias(taken)
    )
    whole, rest = F.floor(F.col(taken) / F.col(size)).cast("int"), (F.col(taken) % F.col(size)).cast("int")
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col(words)), "")
    copies = F.concat(
        F.array_repeat(F.lit(None).cast("int"), whole),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")),
    )
    rows = (
        docs.withColumn(key, row_key()).dropDuplicates([key]).join(counts, key)
        .withColumn(words, F.explode(copies))
    )
    changed = {"text": F.when(F.col(words).isNull(), F.col("text")).otherwise(cut)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(words).isNull(), F.col("n_chars")).otherwise(
            F.length(cut).cast(docs.schema["n_chars"].dataType)
        )
    return rows.withColumns(changed).select(*docs.columns)


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("row_key")
