"""Landing: headers, blank rows, text columns and lineage."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.text import as_text, clean_header

INSERT_TS = "_bronze_insert_ts"
SOURCE_FILE = "_source_file_name"
LINEAGE = (INSERT_TS, SOURCE_FILE)


class HeaderCollision(ValueError):
    """Two headers clean to the same column name."""


def quoted(name: str) -> Column:
    """Column of any name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_headers(df: DataFrame) -> DataFrame:
    names = [clean_header(name) for name in df.columns]
    repeated = sorted(name for name, n in Counter(names).items() if n > 1)
    if repeated:
        raise HeaderCollision(f"several headers clean to {repeated}: {df.columns}")
    return df.toDF(*names)


def _all_null(columns: Iterable[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & quoted(name).isNull()
    return condition


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every source column is NULL; lineage does not count."""
    return df.filter(~_all_null(c for c in df.columns if c not in LINEAGE))


def drop_stray_rows(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows where ``column`` is ``value`` and nothing else is filled."""
    if column not in df.columns:
        return df
    others = [c for c in df.columns if c != column and c not in LINEAGE]
    return df.filter(~(quoted(column).eqNullSafe(F.lit(value)) & _all_null(others)))


def pin_text(df: DataFrame, columns: Iterable[str] = fixed.TEXT_COLUMNS) -> DataFrame:
    """Make the named columns text, where they exist."""
    types = {field.name: field.dataType for field in df.schema}
    return df.withColumns({c: as_text(quoted(c), types[c]) for c in columns if c in types})


def land_text(df: DataFrame) -> DataFrame:
    """Make every column text, padding kept."""
    return pin_text(df, df.columns)


def stamp(df: DataFrame, run_ts: datetime, source_name: str | Column) -> DataFrame:
    """Add when the load ran and where the rows came from.

    ``run_ts`` is one value for the load, so a repeated run or a retried task
    writes the same rows.
    """
    name = source_name if isinstance(source_name, Column) else F.lit(source_name)
    return df.withColumns({INSERT_TS: F.lit(run_ts).cast("timestamp"), SOURCE_FILE: name})
