"""One row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _order(name: str, direction: str) -> Column:
    column = F.col(f"`{name}`")
    return column.desc_nulls_last() if direction == "desc" else column.asc_nulls_last()


def keep_first(df: DataFrame, keys: Sequence[str], order: Mapping[str, str]) -> DataFrame:
    """The first row of each key; NULL is a key value like any other.

    ``order`` maps columns to ``asc`` or ``desc``, NULLs last either way.  All other
    columns break ties, so the result does not depend on how rows are spread over
    tasks.  Ranking is limited to one row per key before the shuffle too, so a key
    holding a large share of the rows sends one row per map task.  Both sorts begin with
    a hash of the key, so that two rows are mostly told apart by one number.
    """
    settled = {*keys, *order}
    ties = {
        field.name: "asc"
        for field in df.schema
        if field.name not in settled and not isinstance(field.dataType, (T.MapType, T.VariantType))
    }
    key = [F.col(f"`{k}`") for k in keys]
    window = Window.partitionBy(F.xxhash64(*key), *key).orderBy(
        *[_order(name, direction) for name, direction in {**order, **ties}.items()]
    )
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


# Keys are dealt to so many buckets to say which rows must be ranked; as many rows are broadcast at most.
BUCKETS = 1 << 16


def first_values(
    df: DataFrame, keys: Sequence[str], order: Mapping[str, str], values: Mapping[str, Column]
) -> DataFrame:
    """The key columns of :func:`keep_first` with ``values`` of the rows kept, most rows not ranked.

    ``values`` are numbers, never NULL, made from columns of ``df``.  Where all rows of a key
    have the same ones it does not matter which row is kept, and only keys and values are
    computed, aggregated and shuffled.  Rows in a bucket with any other key are ranked in
    full; without such a bucket adaptive execution leaves that branch out.
    """
    key = [F.col(f"`{k}`") for k in keys]
    if not values:
        return df.select(*key).distinct()
    # Never NULL, so that joins on it need no filter, which would keep the aggregation from being reused.
    bucket = F.xxhash64(*key).bitwiseAND(F.lit(BUCKETS - 1))
    least = {name: F.col(f"`{name}`") for name in values}
    most = {name: F.col(f"`__most_{name}`") for name in values}
    totals = (
        df.select(*key, *[value.alias(name) for name, value in values.items()])
        .groupBy(*key)
        .agg(*[F.min(c).alias(n) for n, c in least.items()], *[F.max(c).alias(f"__most_{n}") for n, c in least.items()])
        .withColumn("__bucket", bucket)
    )
    agreed = reduce(Column.__and__, [least[name] == most[name] for name in values])
    disputed = F.broadcast(totals.filter(~agreed).select("__bucket").distinct())
    settled = totals.filter(agreed).join(disputed, "__bucket", "left_anti")
    open_rows = df.withColumn("__bucket", bucket).join(disputed, "__bucket")
    ranked = keep_first(open_rows.drop("__bucket"), keys, order)
    return settled.select(*key, *least.values()).unionByName(
        ranked.select(*key, *[value.alias(name) for name, value in values.items()])
    )


def keep_latest(df: DataFrame, keys: Sequence[str], loaded_at: str, file_name: str) -> DataFrame:
    """The latest load of each key; of one load, the first file by name."""
    return keep_first(df, keys, {loaded_at: "desc", file_name: "asc"})


def latest_values(
    df: DataFrame, keys: Sequence[str], loaded_at: str, file_name: str, values: Mapping[str, Column]
) -> DataFrame:
    """:func:`first_values` of the rows of :func:`keep_latest`."""
    return first_values(df, keys, {loaded_at: "desc", file_name: "asc"}, values)
