"""Schema drift: one canonical table out of sources whose columns keep changing.

What varies is data (:class:`ColumnSpec`, :class:`SourceSpec`); :func:`align` turns
one source into the canonical columns and types, and :func:`align_all` unites them.
Specs are matched against schemas on the driver, rows are only ever touched by
column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fixed
from tidemark.functions.dates import between_dates, parse_date
from tidemark.functions.text import as_text
from tidemark.operators.landing import quoted


class MissingColumn(ValueError):
    """A required column has no candidate in the source."""


class NoSources(RuntimeError):
    """Nothing to build the canonical table from."""


@dataclass(frozen=True)
class ColumnSpec:
    """One canonical column.

    sources    candidate source columns, the first present wins
    required   without a candidate: error if true, NULL if false
    is_date    read through the tolerant date parser
    spans      canonical dates that must both be known for the value to count
    legacy     candidates to use instead where the source has the legacy marker
    """

    name: str
    type: str
    sources: tuple[str, ...]
    required: bool = True
    is_date: bool = False
    spans: tuple[str, str] | None = None
    legacy: tuple[str, ...] = ()


@dataclass(frozen=True)
class SourceSpec:
    """One source table: its period label and, if any, its half-open date window."""

    period: str
    table: str
    start: date | None = None
    end: date | None = None


@dataclass(frozen=True)
class TableSpec:
    """The canonical table: columns, label column, window column, legacy marker."""

    columns: tuple[ColumnSpec, ...]
    period_column: str
    window_column: str
    legacy_marker: str | None = None
    min_valid_date: date | None = None

    @property
    def required_groups(self) -> list[tuple[str, ...]]:
        return [c.sources for c in self.columns if c.required]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def pick(available: Iterable[str], candidates: Iterable[str]) -> str | None:
    available = set(available)
    return next((name for name in candidates if name in available), None)


def missing_groups(available: Iterable[str], spec: TableSpec) -> list[tuple[str, ...]]:
    """Required candidate groups that a source covers with no column."""
    available = set(available)
    return [group for group in spec.required_groups if pick(available, group) is None]


def _typed(column: Column, source: T.DataType, spec: ColumnSpec, oldest: date | None) -> Column:
    if spec.is_date:
        day = parse_date(column, source)
        return day if oldest is None else F.when(day >= F.lit(oldest), day)
    if source.simpleString() == spec.type:
        return column
    if spec.type == "string":
        return as_text(column, source)
    if isinstance(source, T.StringType):
        column = F.nullif(F.trim(column), F.lit(""))
    return column.cast(spec.type)


def _in_window(source: Column, data_type: T.DataType, day: Column, spec: SourceSpec) -> Column:
    """Half-open window.  A typed source column is compared as it is, so the filter
    reaches the scan; only text has to be parsed first."""
    typed = isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))
    value = source if typed else day
    bound = data_type if typed else T.DateType()
    # A bound keeps no NULL either, and each use may take the value again.
    bounds = []
    if spec.start is not None:
        bounds.append(value >= F.lit(spec.start).cast(bound))
    if spec.end is not None:
        bounds.append(value < F.lit(spec.end).cast(bound))
    return reduce(Column.__and__, bounds) if bounds else value.isNotNull()


def align(df: DataFrame, spec: TableSpec, source: SourceSpec) -> DataFrame:
    """One source table as canonical columns, typed, windowed and guarded."""

    def window(raw: Column, data_type: T.DataType, day: Column) -> Column:
        return _in_window(raw, data_type, day, source)

    windowed = source.start is not None or source.end is not None
    return _aligned(df, spec, source.table, F.lit(source.period), window if windowed else None)


def _aligned(
    df: DataFrame,
    spec: TableSpec,
    table: str,
    period: Column,
    in_window: Callable[[Column, T.DataType, Column], Column] | None,
) -> DataFrame:
    """``in_window`` gets the window column as it is, its type, and as a parsed day."""
    by_lower = {name.lower(): name for name in df.columns}
    types = {field.name.lower(): field.dataType for field in df.schema}
    legacy = spec.legacy_marker is not None and spec.legacy_marker in by_lower

    values, present = {}, set()
    for column in spec.columns:
        candidates = column.legacy if legacy and column.legacy else column.sources
        found = pick(by_lower, candidates)
        if found is None and column.required:
            raise MissingColumn(f"{table}: no column for {column.name} in {candidates}")
        if found is None:
            value = F.lit(None).cast(column.type)
        else:
            value = _typed(quoted(by_lower[found]), types[found], column, spec.min_valid_date)
            present.add(column.name)
        values[column.name] = value

    if in_window is not None:
        window = next(c for c in spec.columns if c.name == spec.window_column)
        found = pick(by_lower, window.sources)
        raw = quoted(by_lower[found])
        df = df.filter(in_window(raw, types[found], parse_date(raw, types[found])))

    # One projection, so that rows are made once; it takes a date that a guard reads only once.
    # A date the source does not have at all guards nothing.
    guarded = [
        (
            between_dates(values[c.name], *(values[d] for d in c.spans))
            if c.spans and present.issuperset(c.spans)
            else values[c.name]
        ).alias(c.name)
        for c in spec.columns
    ]
    return df.select(*guarded, period.alias(spec.period_column))


def align_all(
    tables: Mapping[str, DataFrame], spec: TableSpec, sources: Iterable[SourceSpec]
) -> DataFrame:
    """Union of all aligned sources; sources without a table are left out."""
    branches = [align(tables[s.table], spec, s) for s in sources if s.table in tables]
    if not branches:
        raise NoSources("no source table was found")
    return reduce(DataFrame.unionByName, branches)


@dataclass(frozen=True)
class StoredTable:
    """Where the files of a table are, one folder, and their schema."""

    name: str
    path: str
    schema: T.StructType

    @property
    def folder(self) -> str:
        return self.path.rstrip("/").rpartition("/")[2]

    @property
    def layout(self) -> frozenset[tuple[str, str]]:
        return frozenset((f.name.lower(), f.dataType.simpleString()) for f in self.schema)


PERIOD_MARK, START_MARK, END_MARK, FOLDER_MARK = "__period", "__start", "__end", "__folder"


def align_stored(
    spark: SparkSession, tables: Mapping[str, StoredTable], spec: TableSpec, sources: Iterable[SourceSpec]
) -> DataFrame:
    """:func:`align_all` with one scan per layout instead of one per table.

    Tables with the same columns and types are read together; period and window of a row
    come from a join of its file's folder with the list of sources, one row each.  So the
    plan grows with the layouts, of which there are few, and not with the tables.
    """
    layouts: dict[frozenset, list[tuple[SourceSpec, StoredTable]]] = {}
    for source in sources:
        if source.table in tables:
            table = tables[source.table]
            layouts.setdefault(table.layout, []).append((source, table))
    if not layouts:
        raise NoSources("no source table was found")
    return reduce(DataFrame.unionByName, [_align_layout(spark, spec, m) for m in layouts.values()])


def _align_layout(
    spark: SparkSession, spec: TableSpec, members: list[tuple[SourceSpec, StoredTable]]
) -> DataFrame:
    paths = {table.folder: table.path for _, table in members}
    if len(paths) < len({table.path for _, table in members}):
        raise ValueError(f"folders of different tables have the same name: {sorted(paths)}")
    marks = spark.createDataFrame(
        pa.table({
            FOLDER_MARK: [table.folder for _, table in members],
            PERIOD_MARK: [source.period for source, _ in members],
            START_MARK: pa.array([source.start for source, _ in members], type=pa.date32()),
            END_MARK: pa.array([source.end for source, _ in members], type=pa.date32()),
        })
    )
    rows = spark.read.schema(members[0][1].schema).parquet(*paths.values())
    # Paths in metadata are encoded as in an URL.
    folder = F.url_decode(F.replace(F.element_at(F.split("_metadata.file_path", "/"), -2), F.lit("+"), F.lit("%2B")))
    # As many rows as sources, which the driver has listed one by one already.
    marked = rows.withColumn(FOLDER_MARK, folder).join(F.broadcast(marks), FOLDER_MARK)

    # What all windows have in common reaches the scan.
    starts, ends = [s.start for s, _ in members], [s.end for s, _ in members]
    whole = SourceSpec(
        "", "", None if None in starts else min(starts), None if None in ends else max(ends)
    )
    windowed = [s.start is not None or s.end is not None for s, _ in members]

    def window(raw: Column, data_type: T.DataType, day: Column) -> Column:
        typed = isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))
        value, bound = (raw, data_type) if typed else (day, T.DateType())
        start, end = F.col(START_MARK).cast(bound), F.col(END_MARK).cast(bound)
        own = (start.isNull() & end.isNull()) | F.coalesce(
            (start.isNull() | (value >= start)) & (end.isNull() | (value < end)) & value.isNotNull(), F.lit(False)
        )
        return own & _in_window(raw, data_type, day, whole) if all(windowed) else own

    name = ", ".join(sorted(table.name for _, table in members))
    return _aligned(marked, spec, name, F.col(PERIOD_MARK), window if any(windowed) else None)


def classify_tables(
    tables: DataFrame,
    required_groups: Iterable[tuple[str, ...]],
    skipped: Iterable[str] = (),
    first_period: tuple[int, int] = fixed.DYNAMIC_START,
) -> DataFrame:
    """Judge each (table_name, columns) row: its period, and whether it is a source.

    Adds year, quarter, period, is_excluded, has_columns and is_source.
    """
    name = F.col("table_name")
    lowered = F.lower(name)
    excluded = lowered.isin(*[s.lower() for s in skipped]) if skipped else F.lit(False)
    excluded = excluded | lowered.startswith(fixed.SKIPPED_PREFIX)
    excluded = excluded | lowered.contains(fixed.SKIPPED_TEXT)
    for suffix in fixed.SKIPPED_SUFFIXES:
        excluded = excluded | lowered.endswith(suffix)

    # One pass for all columns that have one name; a test per column is too much code to be compiled.
    groups = list(required_groups)
    sole = [F.lit(group[0]) for group in groups if len(group) == 1]
    covered = F.size(F.array_except(F.array(*sole), "columns")) == 0 if sole else F.lit(True)
    for group in groups:
        if len(group) != 1:
            covered = covered & F.arrays_overlap("columns", F.array(*map(F.lit, group)))

    def part(i: int) -> Column:
        text = F.nullif(F.regexp_extract(name, fixed.PERIOD_PATTERN, i), F.lit(""))
        return text.cast("int")

    first = F.lit(first_period[0] * 10 + first_period[1])
    judged = tables.withColumns({"year": part(1), "quarter": part(2)}).withColumns({
        "period": F.concat("year", F.lit("_Q"), "quarter"),
        "is_excluded": excluded,
        "has_columns": F.coalesce(covered, F.lit(False)),
    })
    return judged.withColumn(
        "is_source",
        lowered.contains(fixed.TABLE_KEYWORD)
        & F.col("period").isNotNull()
        & (F.col("year") * 10 + F.col("quarter") >= first)
        & ~F.col("is_excluded")
        & F.col("has_columns"),
    )


def discover_sources(
    tables: Mapping[str, DataFrame],
    spec: TableSpec,
    skipped: Iterable[str] = (),
    first_period: tuple[int, int] = fixed.DYNAMIC_START,
) -> list[SourceSpec]:
    """Source tables found by name and columns, in period order."""
    if not tables:
        return []
    spark = next(iter(tables.values())).sparkSession
    # An Arrow table of this size is a local relation: it is judged without a job.
    listing = spark.createDataFrame(
        pa.table({
            "table_name": list(tables),
            "columns": [[c.lower() for c in df.columns] for df in tables.values()],
        })
    )
    return listed_sources(listing, spec, skipped, first_period)


def listed_sources(
    listing: DataFrame,
    spec: TableSpec,
    skipped: Iterable[str] = (),
    first_period: tuple[int, int] = fixed.DYNAMIC_START,
) -> list[SourceSpec]:
    """:func:`discover_sources` on (table_name, columns) rows."""
    judged = classify_tables(listing, spec.required_groups, skipped, first_period)
    found = judged.filter("is_source").select("year", "quarter", "table_name", "period").collect()
    return [SourceSpec(row.period, row.table_name) for row in sorted(found)]
