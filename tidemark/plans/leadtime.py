"""Lead time: shipment workbooks to a canonical leg table to a star schema."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import fixed_values as fixed
from tidemark.functions.dates import calendar_columns, days_between
from tidemark.functions.text import (
    blank_to_null,
    clean_table_name,
    code_text,
    key_text,
    port_name,
    port_text,
    row_key,
    table_name,
)
from tidemark.operators import publish, quality
from tidemark.operators.dedup import keep_latest, latest_values
from tidemark.operators.drift import (
    ColumnSpec,
    SourceSpec,
    StoredTable,
    TableSpec,
    align_all,
    align_stored,
    discover_sources,
    listed_sources,
)
from tidemark.operators.landing import (
    INSERT_TS,
    SOURCE_FILE,
    clean_headers,
    drop_blank_rows,
    drop_stray_rows,
    pin_text,
    quoted,
    stamp,
)
from tidemark.operators.reshape import clustered, unpivot
from tidemark.session import size_shuffles
from tidemark.sources.files import NoMatchingFiles, read_phases, select_files
from tidemark.sources.lake import Lake, Landing, work_folder
from tidemark.sources.workbook import sheet_headers, workbook_rows

SILVER = "leadtime_data"
PERIOD = "_source_period"


def _value(name: str, type_: str, *sources: str, **options) -> ColumnSpec:
    return ColumnSpec(name, type_, sources or (name,), **options)


def _day(name: str, *sources: str) -> ColumnSpec:
    return ColumnSpec(name, "date", sources or (name,), is_date=True)


# The canonical leg: order, types and candidate source names of its columns.
LEG_TABLE = TableSpec(
    columns=(
        _value("wh", "string", "wh", "whr"),
        _value("asn", "string"),
        _value("folio", "string"),
        _value("div", "string", required=False),
        _value("container_size", "string", "continer_size", "container_size", required=False),
        _value("vessel", "string", required=False),
        _value("b_l", "string"),
        _value("port", "string"),
        _value("container", "string"),
        _day(
            "min_req_delivery_date", "min_of_po_head_req_delivery_date", "min_header_delivery_date"
        ),
        _day(
            "max_req_delivery_date", "max_of_po_head_req_delivery_date", "max_header_delivery_date"
        ),
        _value("xfty_range", "double", "min_max_xfty", "max_min_xfty"),
        _value("xfty_to_container_consolidation", "timestamp_ntz"),
        _value("pos_consolidation_to_gate_in", "double"),
        _day("gate_in"),
        _value("gate_in_to_etd", "double", spans=("gate_in", "etd")),
        _day("etd"),
        _value("etd_to_eta", "double", spans=("etd", "current_eta_port")),
        _day("current_eta_port", "current_eta_port", "eta"),
        _value("eta_to_delivery", "double", spans=("current_eta_port", "p_u")),
        _day("p_u"),
        _value("delivery_to_received", "double", spans=("p_u", "asn_receive")),
        _day("asn_receive"),
        _value("max_xft_to_received", "double", legacy=("min_xft_to_received",)),
        _value("min_xft_to_received", "double", legacy=("max_xft_to_received",)),
        _value("avg_xfty_to_received", "double"),
        _value("customer", "string", required=False),
        _value("region", "string"),
        _value("asn_qty", "double", required=False),
        _value(INSERT_TS, "timestamp"),
        _value(SOURCE_FILE, "string"),
    ),
    period_column=PERIOD,
    window_column="etd",
    legacy_marker="min_max_xfty",
)

HISTORICAL = [SourceSpec(*row) for row in fixed.HISTORICAL_PERIODS]

# The hand-checked variant of the union: the same seven tables, the last window open, and
# values as the tables have them, neither guarded by dates nor swapped.
STATIC_TABLE = replace(
    LEG_TABLE, legacy_marker=None, columns=tuple(replace(c, spans=None) for c in LEG_TABLE.columns)
)
STATIC_SOURCES = [*HISTORICAL[:-1], replace(HISTORICAL[-1], end=None)]


# ---------------------------------------------------------------- Silver


def normalize(legs: DataFrame) -> DataFrame:
    """Trim and case the descriptive columns there are; measures, dates and lineage pass through."""
    codes = ["wh", "div", "container_size", "customer", "region"]
    text = {c: code_text(F.col(c)) for c in codes} | {c: blank_to_null(F.col(c)) for c in ["asn", "folio"]}
    if "port" in legs.columns:
        # Two steps, so that the port text is computed once and then looked up.
        legs = legs.withColumn("port", port_text(F.col("port")))
        text["port"] = port_name(F.col("port"))
    return legs.withColumns({c: value for c, value in text.items() if c in legs.columns})


def build_silver(
    tables: Mapping[str, DataFrame],
    sources: Iterable[SourceSpec],
    spec: TableSpec = LEG_TABLE,
    *,
    normalize_first: bool = False,
) -> DataFrame:
    """Aligned union, latest row per leg, normalized text.

    The leg key is compared before normalization unless ``normalize_first`` is set, so
    keys that differ only in case or padding stay apart and show in the duplicate report.
    """
    return finish_silver(align_all(tables, spec, sources), spec, normalize_first=normalize_first)


def finish_silver(legs: DataFrame, spec: TableSpec = LEG_TABLE, *, normalize_first: bool = False) -> DataFrame:
    """Aligned legs to Silver."""
    if normalize_first:
        legs = keep_latest(normalize(legs), fixed.LEG_KEY, INSERT_TS, SOURCE_FILE)
    else:
        legs = normalize(keep_latest(legs, fixed.LEG_KEY, INSERT_TS, SOURCE_FILE))
    lineage = [INSERT_TS, SOURCE_FILE]
    described = [c for c in spec.names if c not in lineage]
    return legs.select(*described, PERIOD, *lineage)


def silver_keys(
    legs: DataFrame, sources: Iterable[SourceSpec] | None = None, known: Sequence[str] = ()
) -> DataFrame:
    """What reports read of :func:`finish_silver`: its leg keys, and no column that they do not need.

    With ``sources`` also the period of each leg, with ``known`` further columns that are 1
    where Silver's have a value and NULL where they have none.
    """
    labels = [] if sources is None else [F.lit(p) for p in dict.fromkeys(s.period for s in sources)]
    values = {f"__{c}": F.col(c).isNotNull().cast("int") for c in known}
    if labels:
        values[f"_{PERIOD}"] = F.coalesce(F.array_position(F.array(*labels), F.col(PERIOD)), F.lit(0))
    kept = latest_values(legs, fixed.LEG_KEY, INSERT_TS, SOURCE_FILE, values)
    shown = [F.nullif(F.col(f"__{c}"), F.lit(0)).alias(c) for c in known]
    if labels:
        shown.append(F.get(F.array(*labels), F.col(f"_{PERIOD}").cast("int") - 1).alias(PERIOD))
    return normalize(kept.select(*fixed.LEG_KEY, *shown))


def all_sources(
    tables: Mapping[str, DataFrame],
    historical: Sequence[SourceSpec] = tuple(HISTORICAL),
    skipped: Iterable[str] = (),
    first_period: tuple[int, int] = fixed.DYNAMIC_START,
    spec: TableSpec = LEG_TABLE,
) -> list[SourceSpec]:
    """Hand-mapped sources that exist, then the discovered ones."""
    mapped = [s for s in historical if s.table in tables]
    return mapped + discover_sources(tables, spec, skipped, first_period)


def source_report(spark: SparkSession, sources: Sequence[SourceSpec]) -> DataFrame:
    """The sources a run included, in order, with the window each was cut to."""
    return spark.createDataFrame(
        [(s.period, s.table, s.start, s.end) for s in sources],
        "period string, table_name string, first_day date, end_day date",
    )


def silver_reports(silver: DataFrame) -> dict[str, DataFrame]:
    """The metrics to look at after a Silver run."""
    return {
        "periods": quality.period_report(silver, PERIOD, "etd"),
        "total": quality.total_report(silver, PERIOD, "etd"),
        "duplicates": quality.duplicate_report(silver),
        "nulls": quality.null_report(silver, PERIOD, NULL_COLUMNS),
    }


NULL_COLUMNS = {
    "wh": "wh",
    "asn": "asn",
    "etd": "etd",
    "current_eta_port": "eta",
    "p_u": "p_u",
    "asn_receive": "asn_receive",
}


# ---------------------------------------------------------------- Gold


def unpivot_phases(silver: DataFrame) -> DataFrame:
    """Nine (Phase, Value) rows per leg, NULL values included."""
    return unpivot(silver, fixed.FACT_IDS, fixed.FACT_PHASES, "Phase", "Value")


def build_fact(silver: DataFrame) -> DataFrame:
    """The lead-time fact: phases as rows, with a hashed row key and a date key.

    Narrow from end to end; the rows stay in the partitions Silver was read in.  The
    parts of the key before and after the phase are the same for all nine rows of a
    leg, so they are put together before it expands.
    """
    column = {shown: name for name, shown in fixed.FACT_IDS}
    phase_at = fixed.FACT_KEY.index("Phase")
    parts = {"__head": fixed.FACT_KEY[:phase_at], "__tail": fixed.FACT_KEY[phase_at + 1 :]}
    keyed = silver.withColumns({
        part: key_text(F.col(column[name]) for name in names) for part, names in parts.items()
    })
    ids = [*fixed.FACT_IDS, *[(part, part) for part in parts]]
    long = unpivot(keyed, ids, fixed.FACT_PHASES, "Phase", "Value")
    return long.select(
        row_key(F.col(name) for name in ("__head", "Phase", "__tail")).alias("fact_row_key"),
        quoted("ASN RECEIVE").cast("date").alias("date_key"),
        *[quoted(name) for name in column],
        "Phase",
        "Value",
    )


def distinct_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """A dimension of the non-NULL values of a column.

    Read from Silver: the fact has the same values, nine times over.
    """
    return df.select(F.col(column).alias(name)).filter(quoted(name).isNotNull()).distinct()


def build_calendar(
    spark: SparkSession, first: date = fixed.CALENDAR_START, last: date = fixed.CALENDAR_END
) -> DataFrame:
    days = days_between(spark.range(1), F.lit(first), F.lit(last))
    return days.select("date_key", *calendar_columns(F.col("date_key")))


def build_gold(silver: DataFrame, phases_path: str) -> dict[str, DataFrame]:
    spark = silver.sparkSession
    return {
        "dim_country": distinct_values(silver, "region", "Country"),
        "dim_date": build_calendar(spark),
        "dim_phase": read_phases(spark, phases_path),
        "dim_port": distinct_values(silver, "port", "Port"),
        "dim_wh": distinct_values(silver, "wh", "WH"),
        "fact_leadtime": build_fact(silver),
    }


# ---------------------------------------------------------------- pipeline


class LoadFailed(RuntimeError):
    """Some workbooks or tabs could not be landed; the others were."""


@dataclass(frozen=True)
class FetchTask:
    """Source workbooks: a folder and a word their names contain."""

    folder: str
    keyword: str


def land_tab(rows: DataFrame, headers: Sequence[str], file_name: str, tab: str) -> DataFrame:
    """One tab as a table of texts: named columns, blank and stray rows dropped."""
    columns = [F.get("cells", F.lit(i)).alias(h) for i, h in enumerate(headers)]
    table = drop_blank_rows(clean_headers(rows.filter("row_no > 1").select(*columns)))
    for file_, tab_, column, value in fixed.STRAY_ROWS:
        if file_name == file_ and clean_table_name(tab) == tab_:
            table = drop_stray_rows(table, column, value)
    return pin_text(table)


def load_bronze(
    lake: Lake, tasks: Iterable[FetchTask], run_ts: datetime, parallel_tabs: int = 8
) -> list[str]:
    """Land every tab of every selected workbook as its own Bronze table.

    The workbooks of all tasks are decoded once, in parallel, into a staged table split by
    tab; each tab is then shaped from its own part.  A task without files, a bad workbook
    or a bad tab does not stop the others: all failures are raised together at the end.
    A workbook that several tasks select is loaded once.
    """
    spark = lake.spark
    failures: list[Exception | str] = []
    landings: list[Landing] = []
    selected, seen = [], set()
    for task in tasks:
        try:
            files = select_files(spark, task.folder, task.keyword)
            paths = {row.path for row in files.select("path").collect()}
            if not paths:
                raise NoMatchingFiles(f"no workbook with {task.keyword!r} in {task.folder}")
        except FileNotFoundError as problem:
            failures.append(problem)
            continue
        if again := paths & seen:
            files = files.filter(~F.col("path").isin(*again))
        seen |= paths
        selected.append(workbook_rows(files))
    if selected:
        staged = f"{work_folder(spark)}/{run_ts:%Y%m%dT%H%M%S}_{uuid.uuid4().hex}"
        try:
            landings, problems = _land_tabs(lake, reduce(DataFrame.union, selected), staged, run_ts, parallel_tabs)
            failures += problems
        finally:
            publish.discard(spark, staged)
    if len(failures) == 1 and isinstance(failures[0], Exception) and not selected:
        raise failures[0]
    if failures:
        raise LoadFailed("; ".join(map(str, failures)))
    return sorted(landing.table_name for landing in landings)


# What became of the tabs of a load: a row per tab, with a reason where it was refused.
TAB_LOG = "landing_log"
TAB_LOG_SCHEMA = (
    "run_ts timestamp, path string, file_name string, tab string, table_name string, rows bigint, "
    "width int, first_row array<string>, reason string"
)


def judge_tabs(decoded: DataFrame) -> DataFrame:
    """A row per (path, tab) of decoded workbook rows: its table, its data rows, its width and
    first row, and why it cannot be landed, NULL if it can.

    One aggregate over the decoded rows; a workbook with one unreadable tab is refused as a
    whole, and so are tabs whose tables would have the same name.
    """
    tabs = decoded.groupBy("table", "path", "file_name", "tab").agg(
        F.count_if((F.col("row_no") > 1) & F.col("error").isNull()).alias("rows"),
        F.max(F.size("cells")).alias("width"),
        F.max(F.when(F.col("row_no") == 1, F.col("cells"))).alias("first_row"),
        F.max("error").alias("error"),
    )
    by_file = Window.partitionBy("path")
    file_error = F.max("error").over(by_file)
    readable = F.count_if(F.col("file_error").isNull()).over(Window.partitionBy("table"))
    reason = F.coalesce(
        F.col("error"),
        F.when(F.col("file_error").isNotNull(), F.lit("its workbook is not readable")),
        F.when(readable > 1, F.concat(F.lit("several tabs land as "), "table")),
    )
    return tabs.withColumn("file_error", file_error).withColumn("reason", reason).select(
        "path", "file_name", "tab", F.col("table").alias("table_name"), "rows", "width", "first_row", "reason"
    )


def _land_tabs(
    lake: Lake, decoded: DataFrame, staged: str, run_ts: datetime, parallel_tabs: int
) -> tuple[list[Landing], list[str]]:
    """Tables landed, and what failed.  One job decodes, one judges the tabs, then each good
    tab is written on its own; manifest and landing log get their rows at the end."""
    spark = lake.spark
    file_name = F.substring_index("path", "/", -1)
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    rows = decoded.withColumn("file_name", file_name).withColumn(
        "table", F.concat(table_name(stem), F.lit("_"), table_name(F.col("tab")))
    )
    rows.write.partitionBy("table").parquet(staged)
    decoded = spark.read.schema(rows.schema).parquet(staged)
    judged = f"{staged}/_judged"
    judge_tabs(decoded).write.parquet(judged)
    tabs = spark.read.parquet(judged)
    good = sorted(tabs.filter("reason IS NULL").collect(), key=lambda t: (t.table_name, t.path))

    def land(tab) -> Landing | str:
        part = decoded.filter(
            (F.col("table") == tab.table_name) & (F.col("path") == tab.path) & (F.col("tab") == tab.tab)
        )
        try:
            headers = sheet_headers(tab.first_row or [], tab.width)
            table = land_tab(part, headers, tab.file_name, tab.tab)
            return lake.land("bronze", tab.table_name, stamp(table, run_ts, tab.file_name), run_ts)
        except Exception as problem:
            return str(problem)

    with ThreadPoolExecutor(parallel_tabs) as pool:
        results = list(pool.map(land, good))
    landings = [result for result in results if isinstance(result, Landing)]
    lake.record(landings)
    late = spark.createDataFrame(
        [(tab.path, tab.tab, result) for tab, result in zip(good, results) if isinstance(result, str)],
        "path string, tab string, late string",
    )
    logged = tabs.join(F.broadcast(late), ["path", "tab"], "left").withColumns({  # one row per bad tab
        "run_ts": F.lit(run_ts).cast("timestamp"), "reason": F.coalesce("reason", "late")
    })
    lake.append(TAB_LOG, logged.select(*StructType.fromDDL(TAB_LOG_SCHEMA).names))
    refused = lake.log(TAB_LOG, TAB_LOG_SCHEMA).filter(
        (F.col("run_ts") == F.lit(run_ts).cast("timestamp")) & F.col("reason").isNotNull()
    )
    # One aggregate: a line for each reason, tabs of one reason together.
    told = F.when(
        F.col("reason").startswith("several tabs land as "), F.col("reason")
    ).otherwise(F.concat_ws(" / ", "file_name", "tab"))
    lines = refused.filter("reason <> 'its workbook is not readable'").select(
        F.when(told == F.col("reason"), told).otherwise(F.concat_ws(": ", told, "reason")).alias("line")
    ).distinct()
    return landings, sorted(row.line for row in lines.collect())


def bronze_sources(
    lake: Lake,
    skipped: Iterable[str] = (),
    historical: Sequence[SourceSpec] = tuple(HISTORICAL),
    first_period: tuple[int, int] = fixed.DYNAMIC_START,
    spec: TableSpec = LEG_TABLE,
) -> tuple[dict[str, StoredTable], list[SourceSpec]]:
    """The Bronze tables that are sources and what they are sources of, read from the
    manifest; only the rows of these tables reach the driver."""
    lake.record_missing("bronze", datetime.now(timezone.utc))
    listing = lake.manifest("bronze")
    found = listed_sources(listing, spec, skipped, first_period)
    wanted = {s.table: s for s in (*historical, *found)}
    rows = listing.filter(F.col("table_name").isin(*wanted)).select("table_name", "run", "schema").collect()
    tables = {
        row.table_name: StoredTable(row.table_name, row.run, StructType.fromJson(json.loads(row.schema)))
        for row in rows
    }
    return tables, [s for s in historical if s.table in tables] + found


def included_sources(lake: Lake, skipped: Iterable[str] = ()) -> DataFrame:
    return source_report(lake.spark, bronze_sources(lake, skipped)[1])


# What each source gave to a Silver run.
SOURCE_LOG = "silver_log"
SOURCE_LOG_SCHEMA = (
    "run_ts timestamp, period string, table_name string, first_day date, end_day date, "
    "landed_rows bigint, kept_rows bigint"
)


def source_log(
    listing: DataFrame, silver: DataFrame, sources: Sequence[SourceSpec], run_ts: datetime
) -> DataFrame:
    """A row per included source: its window, the rows of its table (``listing`` has
    table_name and rows), and the rows of Silver that came from it.

    Rows are counted in what was written, so a task that ran twice counts once.  Where
    several tables have one period, the first has its rows, so that the sum is right.
    """
    spark = silver.sparkSession
    kept = silver.groupBy(F.col(PERIOD).alias("period")).agg(F.count("*").alias("kept_rows"))
    order = {s.period: i for i, s in reversed(list(enumerate(sources)))}
    included = source_report(spark, sources).withColumn(
        "first", F.col("table_name").isin(*[sources[i].table for i in order.values()])
    )
    rows = listing.select("table_name", F.col("rows").alias("landed_rows"))
    return (
        included.join(rows, "table_name", "left").join(kept, "period", "left")
        .select(
            F.lit(run_ts).cast("timestamp").alias("run_ts"), "period", "table_name", "first_day", "end_day",
            "landed_rows", F.when(F.col("first"), F.coalesce("kept_rows", F.lit(0))).otherwise(F.lit(0)).alias("kept_rows"),
        )
    )


def run_leadtime(
    lake: Lake,
    tasks: Iterable[FetchTask],
    phases_path: str,
    run_ts: datetime,
    skipped: Iterable[str] = (),
) -> dict[str, int]:
    """The whole subject: Bronze, Silver behind its gate, Gold.  Returns row counts.

    Silver is written once, as a new run; the gate reads what was written and only then
    does the run become the current table.  Rows are ranged by ``etd``, so files hold
    disjoint spans of it.
    """
    spark = lake.spark
    lake.create_layers()
    load_bronze(lake, tasks, run_ts)

    tables, sources = bronze_sources(lake, skipped)
    size_shuffles(spark, [tables[s.table].path for s in sources])
    legs = align_stored(spark, tables, LEG_TABLE, sources)
    silver = clustered(finish_silver(legs), "etd", *fixed.LEG_KEY)
    rows = lake.write(
        "silver", SILVER, silver,
        check=lambda table: quality.enforce(quality.null_gate(table, "etd"), "Silver etd"),
    )

    written = lake.read("silver", SILVER)
    lake.append(SOURCE_LOG, source_log(lake.manifest("bronze"), written, sources, run_ts))

    gold = build_gold(written, phases_path)
    return {SILVER: rows} | {name: lake.write("gold", name, df) for name, df in gold.items()}
