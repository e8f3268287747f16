"""Data-quality metrics as DataFrames, and the gates that act on them.

A metric function returns rows to look at.  :func:`enforce` runs a gate's one-row
metric and raises when it does not pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.text import blank_to_null
from tidemark.operators.landing import quoted


class DataQualityError(RuntimeError):
    """A gate did not pass."""


def enforce(metric: DataFrame, what: str) -> dict:
    """Raise unless the metric row passes; return the row."""
    row = metric.first().asDict()
    if not row["passed"]:
        raise DataQualityError(f"{what}: {row}")
    return row


def period_report(df: DataFrame, period: str, day: str) -> DataFrame:
    """Rows and date range per period."""
    return (
        df.groupBy(period)
        .agg(
            F.count("*").alias("row_count"),
            F.min(day).alias(f"min_{day}"),
            F.max(day).alias(f"max_{day}"),
        )
        .orderBy(F.col(period).asc_nulls_last())
    )


def total_report(df: DataFrame, period: str, day: str) -> DataFrame:
    """Rows, date range and number of periods of the whole table."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.min(day).alias(f"min_{day}"),
        F.max(day).alias(f"max_{day}"),
        F.countDistinct(period).alias("source_periods"),
    )


def duplicate_report(df: DataFrame, keys: Sequence[str] = fixed.LEG_KEY, top: int = 20) -> DataFrame:
    """The most repeated keys."""
    order = [F.col("duplicate_count").desc(), *[quoted(k).asc_nulls_last() for k in keys]]
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count("*").alias("duplicate_count"))
        .filter("duplicate_count > 1")
        .orderBy(*order)
        .limit(top)
    )


def null_report(df: DataFrame, period: str, columns: Mapping[str, str]) -> DataFrame:
    """NULLs per period; ``columns`` maps a column to its name in the report."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"null_{name}") for c, name in columns.items()]
    return (
        df.groupBy(period)
        .agg(F.count("*").alias("total_rows"), *counts)
        .orderBy(F.col(period).asc_nulls_last())
    )


def null_gate(df: DataFrame, column: str) -> DataFrame:
    """Passes when the column is never NULL."""
    nulls = df.agg(F.count_if(F.col(column).isNull()).alias("null_rows"))
    return nulls.withColumn("passed", F.col("null_rows") == 0)


def grain_gate(df: DataFrame, key: str) -> DataFrame:
    """Passes when every row has its own non-NULL key."""
    counts = df.agg(
        F.count("*").alias("total_rows"), F.countDistinct(quoted(key)).alias("distinct_keys")
    )
    return counts.withColumn("passed", F.col("total_rows") == F.col("distinct_keys"))


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(blank_to_null(quoted(key)).alias(key))


def repeat_report(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Non-blank keys that occur more than once, most frequent first."""
    repeats = (
        _keys(df, key)
        .filter(quoted(key).isNotNull())
        .groupBy(quoted(key))
        .agg(F.count("*").alias("row_count"))
        .filter("row_count > 1")
        .orderBy(F.col("row_count").desc(), quoted(key).asc())
    )
    return repeats if top is None else repeats.limit(top)


def load_report(df: DataFrame, key: str) -> DataFrame:
    """One row: rows read, blank keys, rows kept, repeated keys and rows dropped for them.

    One aggregation per key and a sum over it, so nothing per key leaves the executors.
    """
    per_key = _keys(df, key).groupBy(quoted(key)).agg(F.count("*").alias("n"))
    known: Column = quoted(key).isNotNull()
    repeated = known & (F.col("n") > 1)

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    return per_key.agg(
        total(F.lit(True), F.col("n")).alias("bronze_rows"),
        total(~known, F.col("n")).alias("blank_rows"),
        F.count_if(known).alias("silver_rows"),
        F.count_if(repeated).alias("repeated_keys"),
        total(repeated, F.col("n") - 1).alias("dropped_rows"),
    )
