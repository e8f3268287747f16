"""Left joins against lookup tables.

Which lookups are small is read off the statistics of their files, without a job.  Small
ones are plain joins, which adaptive execution broadcasts once it has seen their real size.
A large one is joined by shuffle, and keys that hold a large share of the left rows are
spread over tasks by a salt, as many as their share is worth.  Both ways give the same
rows and the same order of columns.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.002


@dataclass(frozen=True)
class Lookup:
    """A right-hand table and the (left column, right column) pairs it is joined on.

    Right key columns are dropped after the join.
    """

    table: DataFrame
    on: tuple[tuple[str, str], ...]


def size_bound(df: DataFrame) -> int:
    """Bytes of a table as the optimizer estimates them from its files; filters do not lower
    it, and no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _known(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def hot_keys(
    df: DataFrame, key_sets: Sequence[Sequence[str]], share: float = HOT_SHARE
) -> list[dict[int, float]]:
    """Per key set, the hash of every key that holds at least ``share`` of the rows, with
    its share.

    One pass with a sketch of the most frequent hashes per task, merged in one row; it
    tracks several times as many as can be hot.
    """
    most = int(1 / share)
    hashed = df.select(*[
        F.when(_known(keys), F.xxhash64(*keys)).alias(f"h{i}") for i, keys in enumerate(key_sets)
    ])
    found = hashed.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k({h}, {most}, {min(10 * most, 1_000_000)})").alias(h) for h in hashed.columns],
    ).first()
    return [
        {e["item"]: e["count"] / found["n"] for e in found[h] or [] if e["item"] is not None and e["count"] >= share * found["n"]}
        for h in hashed.columns
    ]


def _salts(hashed: Column, hot: Mapping[int, float], partitions: int) -> Column:
    """Tasks to spread a key over: twice its share of the partitions, one if it is not hot."""
    if not hot:
        return F.lit(1).cast("bigint")
    pairs = [F.lit(x) for h, share in hot.items() for x in (h, max(2, math.ceil(2 * share * partitions)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), hashed), F.lit(1)).cast("bigint")


def salted_left_joins(
    left: DataFrame, lookups: Sequence[Lookup], hot: Mapping[int, float], partitions: int | None = None
) -> DataFrame:
    """Shuffle joins on one set of left keys that split hot keys (hash to share of the rows).

    Hot rows take a salt from their contents and their map partition, which gives
    every retry of a task the same salts; rows with a NULL key, which cannot match,
    are spread the same way.  The lookup rows of a hot key are repeated once per salt:
    all shares together make at most some copies per partition.  The left side is shuffled
    once for all the lookups.
    """
    left_keys = [l for l, _ in lookups[0].on]
    if partitions is None:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    spread = F.xxhash64(*[f"`{c}`" for c in left.columns]) + F.spark_partition_id()
    salts = F.when(_known(left_keys), _salts(F.xxhash64(*left_keys), hot, partitions)).otherwise(
        F.lit(partitions).cast("bigint")
    )
    joined = left.withColumn("__left_salt", F.pmod(spread, salts))
    for lookup in lookups:
        right_keys = [r for _, r in lookup.on]
        copies = _salts(F.xxhash64(*right_keys), hot, partitions)
        right = lookup.table.dropna(subset=right_keys).withColumn(
            "__right_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))
        )
        on = [*lookup.on, ("__left_salt", "__right_salt")]
        condition = reduce(Column.__and__, [F.col(l) == F.col(r) for l, r in on])
        joined = joined.join(right, condition, "left").drop(*right_keys, "__right_salt")
    return joined.drop("__left_salt")


def left_lookups(
    left: DataFrame, lookups: Sequence[Lookup], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left joins with several lookups; a lookup that repeats a key fans rows out.

    Shuffle joins come first and joins that may be broadcast last, so the columns that small
    lookups add are not carried through a shuffle.  Large lookups on the same left keys
    share one.  All keys are columns of ``left``.  Columns come in the order of ``lookups``.
    """
    order = [*left.columns]
    for lookup in lookups:
        right_keys = {r for _, r in lookup.on}
        order += [c for c in lookup.table.columns if c not in right_keys]
    small: list[Lookup] = []
    large: dict[tuple[str, ...], list[Lookup]] = {}
    for lookup in lookups:
        if size_bound(lookup.table) <= broadcast_bytes:
            small.append(lookup)
        else:
            large.setdefault(tuple(l for l, _ in lookup.on), []).append(lookup)
    if large:
        hot = hot_keys(left, list(large))
        for same_keys, shares in zip(large.values(), hot):
            left = salted_left_joins(left, same_keys, shares)
    for lookup in small:
        condition = reduce(Column.__and__, [F.col(l) == F.col(r) for l, r in lookup.on])
        left = left.join(lookup.table, condition, "left").drop(*[r for _, r in lookup.on])
    return left.select(*[f"`{c}`" for c in order])
