"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.landing import quoted


def unpivot(
    df: DataFrame,
    ids: Sequence[tuple[str, str]],
    values: Sequence[tuple[str, str]],
    label: str,
    value: str,
) -> DataFrame:
    """One row per value column, NULL values included.

    ``ids`` and ``values`` are (column, display name) pairs.  This is a narrow step:
    each input row expands in place.
    """
    wide = df.select(*[quoted(c).alias(shown) for c, shown in [*ids, *values]])
    return wide.unpivot(
        [quoted(shown) for _, shown in ids], [quoted(shown) for _, shown in values], label, value
    )


def cells_to_table(
    cells: DataFrame, row_keys: Sequence[str], position: str, text: str, headers: Sequence[str]
) -> DataFrame:
    """Long (row, column position, text) cells as a wide table.

    The header list is given, so no pass over the data is needed to find it, and a
    group is one sheet row, so it is never larger than the header.
    """
    columns = [
        F.max(F.when(F.col(position) == i, F.col(text))).alias(name)
        for i, name in enumerate(headers)
    ]
    return cells.groupBy(*row_keys).agg(*columns)


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows ranged over partitions and sorted by ``keys``, so that files hold disjoint spans
    and a reader can skip those it does not need.

    The keys after the first break ties: rows of one hot value go to several partitions.
    """
    keys = tuple(dict.fromkeys(keys))
    return df.repartitionByRange(*map(quoted, keys)).sortWithinPartitions(*map(quoted, keys))
