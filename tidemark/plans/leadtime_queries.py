"""Queries for lead time: drift, dates, text, dedup, star schema, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.dates import calendar_columns, days_between, parse_date
from tidemark.functions.text import code_text, port_name, port_text
from tidemark.operators import quality
from tidemark.operators.dedup import keep_latest
from tidemark.operators.drift import ColumnSpec, SourceSpec, TableSpec, align_all
from tidemark.operators.joins import Lookup, left_lookups
from tidemark.operators.landing import INSERT_TS, SOURCE_FILE
from tidemark.operators.publish import discard, exists
from tidemark.plans.inputs import FIRST_PERIOD, MAPPED, bronze_legs, order_legs, read, read_spread
from tidemark.plans.leadtime import (
    LEG_TABLE,
    NULL_COLUMNS,
    PERIOD,
    STATIC_TABLE,
    all_sources,
    build_fact,
    build_silver,
    distinct_values,
    normalize,
    silver_keys,
    unpivot_phases,
)
from tidemark.plans.registry import query
from tidemark.sources.files import read_phases, write_phases
from tidemark.sources.lake import work_folder

# ---------------------------------------------------------------- drift

# What the drifted tables say, read from line items directly.
LEGS = """
    sources(period, template, first_day, end_day) AS (
        VALUES ('1995', 1, NULL, DATE '1996-01-01'),
               ('1996_Q1', 2, DATE '1996-01-01', DATE '1997-01-01'),
               ('1997_Q2', 3, DATE '1997-01-01', DATE '1998-01-01'),
               ('1998_Q4', 4, DATE '1998-01-01', DATE '1999-01-01'),
               ('1999_Q2', 5, DATE '1999-01-01', DATE '2000-01-01'),
               ('2000_Q3', 6, DATE '2000-01-01', DATE '2001-02-01'),
               ('2001_Q1', 6, DATE '2001-01-01', NULL)
    ),
    dated AS (
        SELECT *, CAST(l_shipdate AS DATE) AS ship,
               CASE WHEN template < 6 OR l_returnflag <> 'N' OR l_linenumber <> 7
                    THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS etd,
               CASE WHEN l_returnflag <> 'R' OR l_linestatus <> 'F'
                    THEN CAST(l_shipdate AS DATE) - 3 END AS gate_in,
               CASE WHEN l_returnflag <> 'A' OR l_linestatus <> 'O'
                    THEN CAST(l_shipdate AS DATE) + 25 END AS p_u
        FROM lineitem JOIN sources
          ON (l_shipdate >= first_day OR (first_day IS NULL AND l_shipdate IS NOT NULL)
              OR (end_day IS NULL AND l_shipdate IS NULL))
         AND (l_shipdate < end_day OR end_day IS NULL)
    ),
    legs AS (
        SELECT CASE WHEN period = '2001_Q1' THEN l_linestatus || ' '
                    WHEN l_returnflag = 'A' THEN lower(l_linestatus) || ' '
                    ELSE l_linestatus END AS wh,
               CAST(l_orderkey AS VARCHAR) AS asn,
               ' ' || l_linenumber AS folio,
               CASE WHEN template < 4 THEN lower(l_returnflag) END AS div,
               CASE WHEN template < 4 THEN l_linenumber || 'h ' END AS container_size,
               CASE WHEN template < 4 THEN ' V' || l_suppkey END AS vessel,
               'BL' || l_orderkey AS b_l,
               CASE l_returnflag WHEN 'A' THEN 'Hochiminh' WHEN 'N' THEN ' SEKOU '
                    ELSE 'nhava  sheva,' || chr(9) || 'IN' END AS port,
               'C' || l_linenumber AS container,
               ship - 10 AS min_req_delivery_date,
               ship + 10 AS max_req_delivery_date,
               CAST(CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE) AS xfty_range,
               l_shipdate - INTERVAL 5 DAY AS xfty_to_container_consolidation,
               CAST(CAST(round(l_tax * 100) AS INTEGER) AS DOUBLE) AS pos_consolidation_to_gate_in,
               gate_in,
               CASE WHEN gate_in IS NOT NULL AND etd IS NOT NULL THEN l_quantity END
                   AS gate_in_to_etd,
               etd,
               CASE WHEN etd IS NOT NULL THEN CAST(l_linenumber AS DOUBLE) END AS etd_to_eta,
               ship + 20 AS current_eta_port,
               CASE WHEN p_u IS NOT NULL THEN l_quantity + 1 END AS eta_to_delivery,
               p_u,
               CASE WHEN p_u IS NOT NULL THEN l_quantity + 2 END AS delivery_to_received,
               ship + 30 AS asn_receive,
               l_extendedprice AS max_xft_to_received,
               l_quantity AS min_xft_to_received,
               l_quantity + 3 AS avg_xfty_to_received,
               CASE WHEN template < 3 THEN ' cust ' || l_suppkey END AS customer,
               CASE l_returnflag WHEN 'A' THEN 'China ' WHEN 'N' THEN 'CHINA' ELSE ' ' END
                   AS region,
               CASE WHEN template < 3 THEN l_quantity END AS asn_qty,
               epoch_us(l_shipdate + INTERVAL 12 HOUR) AS _bronze_insert_ts,
               'lead time ' || l_returnflag || '.xlsx' AS _source_file_name,
               period AS _source_period
        FROM dated
    )"""

# The same without guards and swaps, of the mapped tables only, the last one open.
STATIC_LEGS = LEGS
for guarded, plain in (
    ("DATE '1999-01-01', DATE '2000-01-01'),", "DATE '1999-01-01', DATE '2000-02-01')"),
    ("               ('2000_Q3', 6, DATE '2000-01-01', DATE '2001-02-01'),\n", ""),
    ("               ('2001_Q1', 6, DATE '2001-01-01', NULL)\n", ""),
    ("CASE WHEN gate_in IS NOT NULL AND etd IS NOT NULL THEN l_quantity END", "l_quantity"),
    ("CASE WHEN etd IS NOT NULL THEN CAST(l_linenumber AS DOUBLE) END", "CAST(l_linenumber AS DOUBLE)"),
    ("CASE WHEN p_u IS NOT NULL THEN l_quantity + 1 END", "l_quantity + 1"),
    ("CASE WHEN p_u IS NOT NULL THEN l_quantity + 2 END", "l_quantity + 2"),
    ("l_extendedprice AS max_xft", "CASE WHEN template < 3 THEN l_quantity ELSE l_extendedprice END AS max_xft"),
    ("l_quantity AS min_xft", "CASE WHEN template < 3 THEN l_extendedprice ELSE l_quantity END AS min_xft"),
):
    if STATIC_LEGS.count(guarded) != 1:
        raise ValueError(f"not once in the SQL: {guarded}")
    STATIC_LEGS = STATIC_LEGS.replace(guarded, plain)

# Written out, so that a wrong name or order in the specification shows.
LEG_NAMES = (
    "wh asn folio div container_size vessel b_l port container min_req_delivery_date max_req_delivery_date "
    "xfty_range xfty_to_container_consolidation pos_consolidation_to_gate_in gate_in gate_in_to_etd etd "
    "etd_to_eta current_eta_port eta_to_delivery p_u delivery_to_received asn_receive max_xft_to_received "
    "min_xft_to_received avg_xfty_to_received customer region asn_qty _bronze_insert_ts _source_file_name "
    "_source_period"
).split()
DATES = "min_req_delivery_date max_req_delivery_date gate_in etd current_eta_port p_u asn_receive".split()
SHOWN = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in DATES else c for c in LEG_NAMES)
CODES = ["wh", "div", "container_size", "customer", "region"]

KEPT = f"""
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY wh, asn, folio, b_l, container, etd
            ORDER BY _bronze_insert_ts DESC NULLS LAST, _source_file_name NULLS LAST,
                     {', '.join(f'{c} NULLS LAST' for c in LEG_NAMES
                                if c not in ('wh', 'asn', 'folio', 'b_l', 'container', 'etd'))}) AS rn
        FROM legs
    ),
    silver AS (
        SELECT * EXCLUDE (rn) REPLACE (
            {', '.join(f"NULLIF(trim(upper({c})), '') AS {c}" for c in CODES)},
            trim(asn) AS asn, trim(folio) AS folio,
            CASE trim(port) WHEN 'Hochiminh' THEN 'HO CHI MINH' WHEN 'SEKOU' THEN 'SHEKOU'
                 ELSE 'NHAVA SHEVA' END AS port)
        FROM ranked WHERE rn = 1
    )"""


def _sources(tables: dict[str, DataFrame]) -> list[SourceSpec]:
    return all_sources(tables, MAPPED, first_period=FIRST_PERIOD)


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = bronze_legs(spark, sf_dir)
    return align_all(tables, LEG_TABLE, _sources(tables))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = bronze_legs(spark, sf_dir)
    return build_silver(tables, _sources(tables))


def _silver_keys(
    spark: SparkSession, sf_dir: str, known: Sequence[str] = (), period: bool = True
) -> DataFrame:
    """:func:`_silver` as the reports read it."""
    tables = bronze_legs(spark, sf_dir)
    sources = _sources(tables)
    return silver_keys(align_all(tables, LEG_TABLE, sources), sources if period else None, known)


@query("schema_align", f"WITH {LEGS} SELECT {SHOWN} FROM legs")
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven drifted tables (and two that are not sources) as one canonical union."""
    return _aligned(spark, sf_dir)


@query("static_align", f"WITH {STATIC_LEGS} SELECT {SHOWN} FROM legs")
def static_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hand-checked variant: mapped tables, an open last window, no guard, no swap."""
    sources = [*MAPPED[:-1], replace(MAPPED[-1], end=None)]
    return align_all(bronze_legs(spark, sf_dir), STATIC_TABLE, sources)


@query("silver_e2e", f"WITH {LEGS}, {KEPT} SELECT {SHOWN} FROM silver")
def silver_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery, alignment, windows, guards, keep-latest and normalization."""
    return _silver(spark, sf_dir)


@query(
    "period_windows",
    """
    SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS etd,
           CASE WHEN l_shipdate < DATE '1996-01-01' THEN '1995'
                WHEN l_shipdate < DATE '1997-01-01' THEN '1996_Q1'
                WHEN l_shipdate < DATE '1998-01-01' THEN '1997_Q2'
                WHEN l_shipdate < DATE '1999-01-01' THEN '1998_Q4'
                WHEN l_shipdate < DATE '2000-01-01' THEN '1999_Q2'
                ELSE 'open' END AS _source_period
    FROM lineitem
    """,
)
def period_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table holds all line items; its half-open window keeps its own period."""
    spec = TableSpec(
        columns=(
            ColumnSpec("l_orderkey", "bigint", ("l_orderkey",)),
            ColumnSpec("l_linenumber", "int", ("l_linenumber",)),
            ColumnSpec("etd", "date", ("l_shipdate",), is_date=True),
        ),
        period_column=PERIOD,
        window_column="etd",
    )
    open_ended = SourceSpec("open", "shipment_lead_time_open", MAPPED[-1].end)
    sources = [*MAPPED, open_ended]
    items = read(spark, sf_dir, "lineitem")
    return align_all({s.table: items for s in sources}, spec, sources)


@query(
    "absent_sources",
    """
    SELECT l_orderkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS etd,
           CASE WHEN l_shipdate < DATE '1996-01-01' THEN '1995' ELSE '1998_Q4' END AS _source_period
    FROM lineitem
    WHERE l_shipdate < DATE '1996-01-01'
       OR (l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '1999-01-01')
    """,
)
def absent_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose table does not exist are left out; those that exist hold all line items."""
    spec = TableSpec(
        columns=(
            ColumnSpec("l_orderkey", "bigint", ("l_orderkey",)),
            ColumnSpec("etd", "date", ("l_shipdate",), is_date=True),
        ),
        period_column=PERIOD,
        window_column="etd",
    )
    items = read(spark, sf_dir, "lineitem")
    return align_all({MAPPED[i].table: items for i in (0, 3)}, spec, MAPPED)


@query(
    "legacy_swap",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS min_xft, l_extendedprice AS max_xft,
           CASE l_linestatus WHEN 'F' THEN 'legacy' ELSE 'current' END AS _source_period
    FROM lineitem
    """,
)
def legacy_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The min and max columns trade places where the legacy marker column is present."""
    spec = TableSpec(
        columns=(
            ColumnSpec("l_orderkey", "bigint", ("l_orderkey",)),
            ColumnSpec("l_linenumber", "int", ("l_linenumber",)),
            ColumnSpec("min_xft", "double", ("min_xft",), legacy=("max_xft",)),
            ColumnSpec("max_xft", "double", ("max_xft",), legacy=("min_xft",)),
        ),
        period_column=PERIOD,
        window_column="etd",
        legacy_marker="min_max_xfty",
    )
    items = read(spark, sf_dir, "lineitem")
    small, large = F.col("l_quantity"), F.col("l_extendedprice")
    ids = ["l_orderkey", "l_linenumber"]
    tables = {
        "old": items.filter(F.col("l_linestatus").eqNullSafe("F")).select(
            *ids, small.alias("max_xft"), large.alias("min_xft"), F.lit(0).alias("MIN_MAX_XFTY")
        ),
        "new": items.filter(~F.col("l_linestatus").eqNullSafe("F")).select(
            *ids, small.alias("min_xft"), large.alias("max_xft"), F.lit(0).alias("max_min_xfty")
        ),
    }
    return align_all(tables, spec, [SourceSpec("legacy", "old"), SourceSpec("current", "new")])


# ---------------------------------------------------------------- columns


@query(
    "date_cascade",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL
                WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 10 IN (3, 4, 5, 6) THEN NULL
                ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS from_text,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS from_timestamp,
           CAST(NULL AS VARCHAR) AS from_number
    FROM orders
    """,
)
def date_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in several ways, some of them no date, and read back."""
    day = F.col("o_orderdate")
    priority, partial = F.col("o_orderpriority"), F.col("o_orderstatus") == "P"
    impossible = F.element_at(
        F.array(*map(F.lit, [" 25:10:00", " 10:61", " 24:00:00", "T99:59"])),
        (F.col("o_orderkey") % 10 - 2).cast("int"),
    )
    text = (
        F.when((priority == "1-URGENT") & partial, F.concat(F.year(day).cast("string"), F.lit("")))
        .when(priority == "1-URGENT", F.date_format(day, " yyyy-MM-dd "))
        .when(
            (priority == "2-HIGH") & (F.col("o_orderkey") % 10).isin(3, 4, 5, 6),
            F.concat(F.date_format(day, "yyyy-MM-dd"), impossible),
        )
        .when((priority == "2-HIGH") & partial, F.date_format(day, "yyyy/M/d"))
        .when(priority == "2-HIGH", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(priority == "3-MEDIUM", F.date_format(day, "MM/dd/yy"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(day, "M/d/yyyy"))
        .otherwise(F.date_format(day, "MM-dd-yyyy"))
    )
    orders = read(spark, sf_dir, "orders").withColumn("text", text)
    types = {f.name: f.dataType for f in orders.schema}
    return orders.select(
        "o_orderkey",
        parse_date(F.col("text"), types["text"]).alias("from_text"),
        parse_date(day, types["o_orderdate"]).alias("from_timestamp"),
        parse_date(F.col("o_custkey"), types["o_custkey"]).alias("from_number"),
    )


@query(
    "leg_guard",
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN o_orderstatus <> 'P' AND l_returnflag <> 'N' THEN l_quantity END AS guarded,
           l_quantity AS unguarded
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def leg_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A duration is kept only where the order date and the ship date both parse."""
    spec = TableSpec(
        columns=(
            ColumnSpec("l_orderkey", "bigint", ("l_orderkey",)),
            ColumnSpec("l_linenumber", "int", ("l_linenumber",)),
            ColumnSpec("ordered", "date", ("ordered",), is_date=True),
            ColumnSpec("shipped", "date", ("shipped",), is_date=True),
            ColumnSpec("guarded", "double", ("l_quantity",), spans=("ordered", "shipped")),
            ColumnSpec("unguarded", "double", ("l_quantity",)),
        ),
        period_column=PERIOD,
        window_column="ordered",
    )
    ordered = F.when(F.col("o_orderstatus") == "P", "TBD").otherwise(
        F.date_format("o_orderdate", "M/d/yyyy")
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", ordered.alias("ordered"))
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("shipped"),
    )
    legs = left_lookups(items, [Lookup(orders, (("l_orderkey", "o_orderkey"),))])
    guarded = align_all({"legs": legs}, spec, [SourceSpec("all", "legs")])
    return guarded.select("l_orderkey", "l_linenumber", "guarded", "unguarded")


@query(
    "text_normalize",
    f"""
    SELECT upper(c_mktsegment) AS wh, c_name AS asn,
           NULLIF(CAST(c_nationkey AS VARCHAR), '0') AS folio,
           CASE WHEN c_nationkey >= 5 THEN 'D' || c_nationkey END AS div,
           'X' || chr(9) AS container_size, ' as is ' AS vessel, upper(c_name) AS customer,
           CAST(NULL AS VARCHAR) AS region
    FROM customer
    """,
)
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    number = nation.cast("string")
    noisy = read(spark, sf_dir, "customer").select(
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("wh"),
        F.concat("c_name", F.lit("  ")).alias("asn"),
        F.when(nation == 0, "   ").otherwise(F.concat(F.lit(" "), number)).alias("folio"),
        F.when(nation < 5, " ").otherwise(F.concat(F.lit("d"), number)).alias("div"),
        F.lit(" x\t ").alias("container_size"),
        F.lit(" as is ").alias("vessel"),
        F.lower("c_name").alias("customer"),
        F.lit("").alias("region"),
        F.lit("x").alias("port"),
    )
    return normalize(noisy).drop("port")


@query(
    "port_normalize",
    """
    SELECT c_custkey,
           CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HO CHI MINH' WHEN 'MACHINERY' THEN 'SHEKOU'
                WHEN 'FURNITURE' THEN 'NHAVA SHEVA' WHEN 'BUILDING' THEN 'HO CHI MINH'
                ELSE 'PORT ' || upper(c_name) END AS port
    FROM customer WHERE c_nationkey > 0
    UNION ALL
    SELECT c_custkey, NULL FROM customer WHERE c_nationkey = 0
    """,
)
def port_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    raw = (
        F.when(F.col("c_nationkey") == 0, " \t ")
        .when(segment == "HOUSEHOLD", "ho  chi\tminh")
        .when(segment == "MACHINERY", " SEKOU ")
        .when(segment == "FURNITURE", "Nhava \n Sheva,  IN")
        .when(segment == "BUILDING", "Hochiminh")
        .otherwise(F.concat(F.lit("port "), "c_name"))
    )
    return read(spark, sf_dir, "customer").select(
        "c_custkey", port_name(port_text(raw)).alias("port")
    )


@query(
    "dedup_latest",
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_returnflag, l_partkey, l_suppkey, l_quantity,
                     l_extendedprice, l_discount, l_tax, l_linestatus) AS rn
        FROM lineitem)
    WHERE rn = 1
    """,
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem")
    return keep_latest(items, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_returnflag")


# ---------------------------------------------------------------- star schema

ORDER_LEGS = """
    order_legs AS (
        SELECT o_orderstatus AS "WH", CAST(o_orderkey AS VARCHAR) AS "ASN#",
               o_orderpriority AS "Folio",
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS "Port",
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END
                   AS "ASN RECEIVE",
               NULLIF(o_orderstatus, 'P') AS "COUNTRY",
               [{'p': 'Avg XFTY to Received', 'v': o_totalprice},
                {'p': 'Min XFT to Received',
                 'v': CASE WHEN o_totalprice > 100000 THEN o_totalprice END},
                {'p': 'Max XFT to Received', 'v': o_totalprice + 1},
                {'p': 'Delivery to Received', 'v': CAST(o_custkey AS DOUBLE)},
                {'p': 'ETA to Delivery', 'v': CAST(NULL AS DOUBLE)},
                {'p': 'ETD to ETA', 'v': CAST(day(o_orderdate) AS DOUBLE)},
                {'p': 'Gate In to ETD',
                 'v': CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE END},
                {'p': 'POS Consolidation to Gate In', 'v': CAST(month(o_orderdate) AS DOUBLE)},
                {'p': 'Max-Min XFTY', 'v': CAST(quarter(o_orderdate) AS DOUBLE)}] AS measures
        FROM orders
    ),
    long AS (
        SELECT "WH", "ASN#", "Folio", "Port", "ASN RECEIVE", "COUNTRY", m.p AS "Phase",
               m.v AS "Value"
        FROM (SELECT * EXCLUDE (measures), unnest(measures) AS m FROM order_legs)
    )"""

LONG_COLUMNS = """
    "WH", "ASN#", "Folio", "Port", CAST("ASN RECEIVE" AS VARCHAR) AS "ASN RECEIVE", "COUNTRY",
    "Phase", "Value\""""

KEY = " || '|' || ".join(
    f"ifnull(CAST(\"{name}\" AS VARCHAR), '<NULL>')"
    for name in ("ASN RECEIVE", "ASN#", "Folio", "COUNTRY", "Phase", "Port", "WH")
)


@query("fact_unpivot", f"WITH {ORDER_LEGS} SELECT {LONG_COLUMNS} FROM long")
def fact_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_phases(order_legs(spark, sf_dir))


@query(
    "fact_key",
    f"""
    WITH {ORDER_LEGS}
    SELECT md5({KEY}) AS fact_row_key, CAST("ASN RECEIVE" AS VARCHAR) AS date_key, {LONG_COLUMNS}
    FROM long
    """,
)
def fact_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact: unpivoted, keyed, dated."""
    return build_fact(order_legs(spark, sf_dir))


@query(
    "dim_distinct",
    f"""
    WITH {ORDER_LEGS}
    SELECT DISTINCT 'WH' AS dimension, "WH" AS name FROM long WHERE "WH" IS NOT NULL
    UNION ALL SELECT DISTINCT 'Port', "Port" FROM long WHERE "Port" IS NOT NULL
    UNION ALL SELECT DISTINCT 'Country', "COUNTRY" FROM long WHERE "COUNTRY" IS NOT NULL
    """,
)
def dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse, port and country dimensions, stacked."""
    legs = order_legs(spark, sf_dir)
    dimensions = [("wh", "WH"), ("port", "Port"), ("region", "Country")]
    return reduce(
        DataFrame.unionByName,
        [
            distinct_values(legs, column, "name").select(F.lit(shown).alias("dimension"), "name")
            for column, shown in dimensions
        ],
    )


@query(
    "dim_date",
    """
    WITH days AS (
        SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))::DATE AS d
        FROM orders
    ), counted AS (
        SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1
    )
    SELECT CAST(d AS VARCHAR) AS date_key, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter_number, 'Q' || quarter(d) AS quarter,
           CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
           left(monthname(d), 3) AS month_short_name, CAST(day(d) AS INTEGER) AS day,
           CAST(dayofweek(d) AS INTEGER) AS day_of_week_number, dayname(d) AS day_name,
           CAST(weekofyear(d) AS INTEGER) AS week_number, strftime(d, '%Y-%m') AS year_month,
           dayofweek(d) IN (0, 6) AS is_weekend, ifnull(orders, 0) AS orders
    FROM days LEFT JOIN counted USING (d)
    """,
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the days the orders span, with the orders of each day."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    bounds = orders.agg(F.min("d").alias("first"), F.max("d").alias("last"))
    days = days_between(bounds, F.col("first"), F.col("last"))
    counted = orders.groupBy(F.col("d").alias("date_key")).agg(F.count("*").alias("orders"))
    return days.join(counted, "date_key", "left").select(
        "date_key",
        *calendar_columns(F.col("date_key")),
        F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"),
    )


def _wide_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order as legs: ship and order dates and nine measures."""
    items = read_spread(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate",
        F.col("l_extendedprice").alias("price"),
    )
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    legs = left_lookups(items, [Lookup(orders, (("l_orderkey", "o_orderkey"),))])
    quantity = F.col("l_quantity")
    line = F.col("l_linenumber").cast("string")
    transit = F.date_diff("l_shipdate", "o_orderdate").cast("double")
    return legs.select(
        F.col("l_linestatus").alias("wh"),
        F.col("l_orderkey").cast("string").alias("asn"),
        line.alias("folio"),
        F.concat(F.lit("BL"), F.col("l_orderkey").cast("string")).alias("b_l"),
        F.concat(F.lit("C"), line).alias("container"),
        F.col("o_orderdate").cast("date").alias("etd"),
        code_text(F.col("o_orderpriority")).alias("port"),
        F.col("l_shipdate").cast("date").alias("asn_receive"),
        F.nullif("o_orderstatus", F.lit("P")).alias("region"),
        F.col("price").alias("avg_xfty_to_received"),
        quantity.alias("min_xft_to_received"),
        (quantity + 1).alias("max_xft_to_received"),
        (quantity + 2).alias("delivery_to_received"),
        F.when(F.col("l_returnflag") != "N", quantity + 3).alias("eta_to_delivery"),
        transit.alias("etd_to_eta"),
        (quantity + 4).alias("gate_in_to_etd"),
        (quantity + 5).alias("pos_consolidation_to_gate_in"),
        F.lit(0.0).alias("xfty_range"),
        F.col("l_shipdate").alias(INSERT_TS),
        F.col("l_returnflag").alias(SOURCE_FILE),
    )


def _phases_path(spark: SparkSession) -> str:
    """The phase master as a CSV, written once per application."""
    path = f"{work_folder(spark)}/phases_{spark.sparkContext.applicationId}"
    if not exists(spark, f"{path}/_SUCCESS"):
        discard(spark, path)
        write_phases(spark, path)
    return path


@query(
    "dim_phase",
    """
    WITH kept AS (
        SELECT *, date_diff('day', o_orderdate, l_shipdate) AS transit
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        QUALIFY row_number() OVER (
            PARTITION BY l_linestatus, l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_returnflag, l_extendedprice, l_quantity) = 1
    ), phases(phase_order, "Phase", phase_alias, phase_group, benchmark_days, is_assumption) AS (
        VALUES (1, 'POS Consolidation to Gate In', 'Gate in', 'Transit Leg', 3, TRUE),
               (2, 'Gate In to ETD', 'Gate in to ETD', 'Transit Leg', NULL, FALSE),
               (3, 'ETD to ETA', 'ETD to ETA', 'Transit Leg', NULL, FALSE),
               (4, 'ETA to Delivery', 'ETA to Delivery', 'Transit Leg', NULL, FALSE),
               (5, 'Delivery to Received', 'Deli. to rec.', 'Transit Leg', NULL, FALSE),
               (6, 'Max-Min XFTY', 'Max-Min xfty', 'Summary', NULL, FALSE),
               (7, 'Min XFT to Received', 'min xft to received.', 'Summary', NULL, FALSE),
               (8, 'Max XFT to Received', 'max xft to received.', 'Summary', NULL, FALSE),
               (9, 'Avg XFTY to Received', 'Avg total', 'Summary', NULL, FALSE)
    ), valued AS (
        SELECT phases.*, kept.l_orderkey, kept.l_linenumber, l_linestatus, l_shipdate,
               o_orderstatus, o_orderpriority,
               CASE phase_order WHEN 1 THEN l_quantity + 5 WHEN 2 THEN l_quantity + 4
                    WHEN 3 THEN transit
                    WHEN 4 THEN CASE WHEN l_returnflag <> 'N' THEN l_quantity + 3 END
                    WHEN 5 THEN l_quantity + 2 WHEN 6 THEN 0 WHEN 7 THEN l_quantity
                    WHEN 8 THEN l_quantity + 1 ELSE l_extendedprice END AS v
        FROM kept, phases
    )
    SELECT "Phase", phase_alias, phase_order, phase_group, benchmark_days, is_assumption,
           count(*) AS rows, count(v) AS filled,
           CAST(sum(CAST(floor(v * 100 + 0.5) AS BIGINT)) AS VARCHAR) AS total_hundredths,
           CAST(sum(ascii(md5(
               CAST(l_shipdate AS DATE) || '|' || l_orderkey || '|' || l_linenumber || '|'
               || ifnull(NULLIF(o_orderstatus, 'P'), '<NULL>') || '|' || "Phase" || '|'
               || o_orderpriority || '|' || l_linestatus))) AS BIGINT) AS key_sum
    FROM valued GROUP BY ALL
    """,
)
def dim_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: join, keep latest, unpivot, row key, and totals per phase in
    business order, with the phase master read from CSV."""
    legs = keep_latest(_wide_legs(spark, sf_dir), fixed.LEG_KEY, INSERT_TS, SOURCE_FILE)
    hundredths = F.floor(F.col("Value") * 100 + 0.5)
    per_phase = (
        build_fact(legs)
        .groupBy("Phase")
        .agg(
            F.count("*").alias("rows"),
            F.count("Value").alias("filled"),
            F.sum(hundredths.cast("decimal(18,0)")).alias("total_hundredths"),
            F.sum(F.ascii("fact_row_key")).alias("key_sum"),
        )
    )
    # A master kept by hand, nine rows.
    phases = spark.createDataFrame(read_phases(spark, _phases_path(spark)).collect(), fixed.PHASE_SCHEMA)
    return phases.join(per_phase, "Phase").orderBy("phase_order")


# ---------------------------------------------------------------- reports


@query(
    "report_period",
    f"""
    WITH {LEGS}, {KEPT}
    SELECT _source_period, count(*) AS row_count, CAST(min(etd) AS VARCHAR) AS min_etd,
           CAST(max(etd) AS VARCHAR) AS max_etd
    FROM silver GROUP BY _source_period ORDER BY _source_period
    """,
)
def report_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.period_report(_silver_keys(spark, sf_dir), PERIOD, "etd")


@query(
    "report_total",
    f"""
    WITH {LEGS}, {KEPT}
    SELECT count(*) AS total_rows, CAST(min(etd) AS VARCHAR) AS min_etd,
           CAST(max(etd) AS VARCHAR) AS max_etd,
           count(DISTINCT _source_period) AS source_periods
    FROM silver
    """,
)
def report_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.total_report(_silver_keys(spark, sf_dir), PERIOD, "etd")


@query(
    "report_duplicates",
    f"""
    WITH {LEGS}, {KEPT}
    SELECT wh, asn, folio, b_l, container, CAST(etd AS VARCHAR) AS etd,
           count(*) AS duplicate_count
    FROM silver GROUP BY ALL HAVING count(*) > 1
    ORDER BY duplicate_count DESC, wh NULLS LAST, asn NULLS LAST, folio NULLS LAST,
             b_l NULLS LAST, container NULLS LAST, etd NULLS LAST
    LIMIT 20
    """,
)
def report_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty most repeated leg keys of Silver: keys that are equal once normalized."""
    return quality.duplicate_report(_silver_keys(spark, sf_dir, period=False))


@query(
    "report_nulls",
    f"""
    WITH {LEGS}, {KEPT}
    SELECT _source_period, count(*) AS total_rows,
           {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS null_{n}'
                      for c, n in NULL_COLUMNS.items())}
    FROM silver GROUP BY _source_period ORDER BY _source_period
    """,
)
def report_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = [c for c in NULL_COLUMNS if c not in fixed.LEG_KEY]
    return quality.null_report(_silver_keys(spark, sf_dir, known), PERIOD, NULL_COLUMNS)


@query(
    "null_gate",
    f"WITH {LEGS}, {KEPT} SELECT count(*) AS null_rows, count(*) = 0 AS passed"
    " FROM silver WHERE etd IS NULL",
)
def null_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_gate(_silver_keys(spark, sf_dir, period=False), "etd")


@query(
    "grain_check",
    """
    SELECT 'orders' AS "table", count(*) AS total_rows,
           count(DISTINCT o_orderkey) AS distinct_keys,
           count(*) = count(DISTINCT o_orderkey) AS passed
    FROM orders
    UNION ALL
    SELECT 'lineitem', count(*), count(DISTINCT l_orderkey),
           count(*) = count(DISTINCT l_orderkey)
    FROM lineitem
    """,
)
def grain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    gates = [
        quality.grain_gate(read(spark, sf_dir, table), key).select(
            F.lit(table).alias("table"), "*"
        )
        for table, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, gates)
