"""ERP base tables, from JDBC or from Parquet through one interface.

Only the columns the item query needs are read, and the company filter goes to the
source.  The joins run in Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed


def one_company(table: DataFrame, column: str, company: int) -> DataFrame:
    """Rows of one company; a plain equality, which every source can evaluate."""
    return table.filter(F.col(column) == F.lit(company))


def sql_text(value: object) -> str:
    """A value as SQL; texts in quotes, with the mark of a national character string."""
    if isinstance(value, str):
        quoted = value.replace("'", "''")
        return f"N'{quoted}'"
    return str(value)


def range_conditions(key: str, cuts: Sequence[object]) -> list[str]:
    """WHERE conditions of the ranges between cut points: disjoint, covering every row, each
    an index range.  Rows without key are in the first."""
    bounds = list(dict.fromkeys(cuts))
    if not bounds:
        return ["1 = 1"]
    parts = [f"{key} < {sql_text(bounds[0])} OR {key} IS NULL"]
    for low, high in zip(bounds, bounds[1:]):
        parts.append(f"{key} >= {sql_text(low)} AND {key} < {sql_text(high)}")
    return [*parts, f"{key} >= {sql_text(bounds[-1])}"]


def cut_query(table: str, key: str, parts: int) -> str:
    """SQL for the first keys (cut) of ``parts`` ranges of equally many rows, numbered from 2.

    The source orders them itself, so its collation decides, as it does in the conditions;
    it reads the index of the key only.
    """
    return (
        f"SELECT part, MIN({key}) AS cut FROM (SELECT {key}, NTILE({parts}) OVER (ORDER BY {key}) AS part "
        f"FROM {table} WHERE {key} IS NOT NULL) ranked WHERE part > 1 GROUP BY part"
    )


@dataclass(frozen=True)
class ParquetErp:
    """ERP tables exported as Parquet folders below a path."""

    root: str

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/{name}")


@dataclass(frozen=True)
class JdbcErp:
    """ERP tables read over JDBC, each in ``parts`` parts: ranges of its key once
    :meth:`ranged` has found cut points, otherwise by a checksum of the key, for which the
    source reads the whole table once per part.

    ``splits`` gives, for tables that should be cut otherwise, the WHERE conditions of
    disjoint parts covering the table, one per task.
    """

    url: str
    user: str
    password: str = field(repr=False)
    schema: str = fixed.ERP_SCHEMA
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
    login_seconds: int = 30
    query_seconds: int = 600
    fetch_rows: int = 10_000
    parts: int = 16
    part_condition: str = "ABS(CAST(CHECKSUM({key}) AS BIGINT)) % {parts} = {part}"
    splits: Mapping[str, list[str]] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        values = {"url": self.url, "user": self.user, "password": self.password}
        unset = [name for name, value in values.items() if not value or value.startswith("<")]
        if unset:
            raise ValueError(f"ERP connection is not filled in: {', '.join(unset)}")
        return {
            **values,
            "driver": self.driver,
            "loginTimeout": str(self.login_seconds),
            "queryTimeout": str(self.query_seconds),
            "fetchsize": str(self.fetch_rows),
            "ApplicationIntent": "ReadOnly",
        }

    def ranged(self, spark: SparkSession) -> JdbcErp:
        """The same source with cut points for every table that has no splits of its own."""
        options = self.options()
        reader = spark.read.format("jdbc").options(**options)
        splits = dict(self.splits)
        for name, columns in fixed.ERP_COLUMNS.items():
            if name not in splits:
                query = cut_query(f"{self.schema}.{name}", columns[1], self.parts)
                rows = sorted(reader.option("query", query).load().collect(), key=lambda row: row[0])
                splits[name] = range_conditions(columns[1], [row[1] for row in rows])
        return replace(self, splits=splits)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        options = self.options()
        url = options.pop("url")
        return spark.read.jdbc(
            url, f"{self.schema}.{name}", predicates=self.conditions(name), properties=options
        )

    def conditions(self, name: str) -> list[str]:
        """WHERE conditions of the parts a table is read in."""
        if name in self.splits:
            return self.splits[name]
        key = fixed.ERP_COLUMNS[name][1]
        return [self.part_condition.format(key=key, parts=self.parts, part=i) for i in range(self.parts)]


def read_erp(
    spark: SparkSession, source: ParquetErp | JdbcErp, company: int
) -> dict[str, DataFrame]:
    """Every base table: needed columns, one company."""
    tables = {}
    for name, columns in fixed.ERP_COLUMNS.items():
        rows = source.table(spark, name).select(*columns)
        tables[name] = one_company(rows, columns[0], company)
    return tables
