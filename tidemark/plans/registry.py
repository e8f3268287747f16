"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import day_text
from tidemark.operators.landing import quoted

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Dates and decimals as text and instants as microseconds, which two engines
    print alike; everything else as it is."""
    columns = []
    for field in df.schema:
        column = quoted(field.name)
        if isinstance(field.dataType, T.DateType):
            column = day_text(column)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.unix_micros(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL to check it against where there is one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: comparable(function(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register
