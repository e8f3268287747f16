"""Queries for masters, layouts, the manifest, logs and proofs about written tables."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import publish
from tidemark.operators.clustering import clustered_grain_gate, file_spans, key_runs, overlap_report
from tidemark.operators.drift import (
    ColumnSpec,
    MissingColumn,
    SourceSpec,
    TableSpec,
    align_all,
    align_stored,
    classify_tables,
)
from tidemark.operators.reshape import clustered
from tidemark.plans.inputs import FIRST_PERIOD, MAPPED, bronze_legs, read
from tidemark.plans.landing_queries import RUN_TS
from tidemark.plans.leadtime import (
    LEG_TABLE,
    PERIOD,
    SILVER,
    bronze_sources,
    finish_silver,
    judge_tabs,
    source_log,
)
from tidemark.plans.leadtime_queries import KEPT, LEGS, SHOWN
from tidemark.plans.registry import query
from tidemark.sources.erp import range_conditions
from tidemark.sources.files import read_master
from tidemark.sources.lake import MANIFEST, MANIFEST_SCHEMA, Lake, work_folder


def _lake(spark: SparkSession, name: str) -> Lake:
    lake = Lake(spark, f"{work_folder(spark)}/{name}_{uuid.uuid4().hex}")
    lake.create_layers()
    return lake


# ---------------------------------------------------------------- masters


@query(
    "csv_by_name",
    """
    SELECT c_custkey, c_name || ', "of" ' || c_mktsegment AS c_name, NULLIF(c_nationkey, 3) AS c_nationkey,
           c_acctbal, c_nationkey % 2 = 0 AS is_even, TRUE AS bad_cell_refused, TRUE AS missing_column_refused
    FROM customer
    """,
)
def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers from a CSV whose columns stand in another order, under names in other cases,
    beside a column that is not wanted; files with a word for a number or without a column
    are refused."""
    root = _lake(spark, "masters").root
    nation = F.nullif("c_nationkey", F.lit(3))
    written = read(spark, sf_dir, "customer").select(
        (F.col("c_nationkey") % 2 == 0).alias("Is_Even"),
        F.concat("c_name", F.lit(', "of" '), "c_mktsegment").alias("C_NAME"),
        F.lit("unused").alias("note"),
        F.col("c_acctbal"),
        nation.alias("c_nationkey"),
        F.col("c_custkey"),
    )
    written.write.csv(f"{root}/good", header=True, escape='"')
    word = F.when(F.col("c_custkey") % 100 == 1, "one").otherwise(F.col("c_nationkey").cast("string"))
    written.withColumn("c_nationkey", word).write.csv(f"{root}/bad", header=True, escape='"')
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, is_even boolean"

    def refused(path: str, schema: str) -> bool:
        try:
            # Even where the bad column is not read.
            read_master(spark, path, schema).select("c_custkey").write.format("noop").mode("overwrite").save()
        except (PySparkException, ValueError):
            return True
        return False

    return read_master(spark, f"{root}/good", schema).withColumns({
        "bad_cell_refused": F.lit(refused(f"{root}/bad", schema)),
        "missing_column_refused": F.lit(refused(f"{root}/good", schema + ", c_phone string")),
    })


# ---------------------------------------------------------------- layouts and manifest


def _landed_legs(spark: SparkSession, sf_dir: str) -> Lake:
    """The drifted tables in Bronze, with their rows in the manifest; one was landed before."""
    lake = _lake(spark, "layouts")
    tables = bronze_legs(spark, sf_dir)
    first = next(iter(tables))
    lake.record([lake.land("bronze", first, tables[first].limit(1).drop("etd"), RUN_TS - timedelta(days=1))])
    with ThreadPoolExecutor(4) as pool:
        lake.record(list(pool.map(lambda item: lake.land("bronze", *item, RUN_TS), tables.items())))
    return lake


def _stored_sources(lake: Lake):
    return bronze_sources(lake, historical=MAPPED, first_period=FIRST_PERIOD)


@query("layout_align", f"WITH {LEGS} SELECT {SHOWN} FROM legs")
def layout_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed tables found in the manifest and aligned by one scan per layout."""
    tables, sources = _stored_sources(_landed_legs(spark, sf_dir))
    return align_stored(spark, tables, LEG_TABLE, sources)


@query(
    "included_sources",
    f"""
    WITH {LEGS}, {KEPT}, held(table_name, first, last) AS (
        VALUES ('shipment_lead_time_1995_data', NULL, TIMESTAMP '1996-02-01'),
               ('shipment_lead_time_1996_q1_data', TIMESTAMP '1995-12-01', TIMESTAMP '1997-02-01'),
               ('shipment_lead_time_1997_q2_data', TIMESTAMP '1996-12-01', TIMESTAMP '1998-02-01'),
               ('shipment_lead_time_1998_q4_data', TIMESTAMP '1997-12-01', TIMESTAMP '1999-02-01'),
               ('shipment_lead_time_1999_q2_data', TIMESTAMP '1998-12-01', TIMESTAMP '2000-02-01'),
               ('shipment_lead_time_2000_q3_q3_2000', TIMESTAMP '2000-01-01', TIMESTAMP '2001-02-01'),
               ('shipment_lead_time_2001_q1_data', TIMESTAMP '2001-01-01', NULL)
    ), landed AS (
        SELECT table_name, count(l_orderkey) AS landed_rows
        FROM held LEFT JOIN lineitem
          ON (l_shipdate >= first OR (first IS NULL AND l_shipdate IS NOT NULL) OR (last IS NULL AND l_shipdate IS NULL))
         AND (l_shipdate < last OR last IS NULL) GROUP BY table_name
    ), windows(period, table_name, first_day, end_day) AS (
        VALUES ('1995', 'shipment_lead_time_1995_data', NULL, '1996-01-01'),
               ('1996_Q1', 'shipment_lead_time_1996_q1_data', '1996-01-01', '1997-01-01'),
               ('1997_Q2', 'shipment_lead_time_1997_q2_data', '1997-01-01', '1998-01-01'),
               ('1998_Q4', 'shipment_lead_time_1998_q4_data', '1998-01-01', '1999-01-01'),
               ('1999_Q2', 'shipment_lead_time_1999_q2_data', '1999-01-01', '2000-01-01'),
               ('2000_Q3', 'shipment_lead_time_2000_q3_q3_2000', NULL, NULL),
               ('2001_Q1', 'shipment_lead_time_2001_q1_data', NULL, NULL)
    )
    SELECT period, table_name, first_day, end_day, landed_rows,
           (SELECT count(*) FROM silver WHERE _source_period = period) AS kept_rows,
           (SELECT count(*) FROM silver) AS silver_rows
    FROM windows JOIN landed USING (table_name)
    """,
)
def included_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source gave to a written Silver table: landed and kept rows, windows."""
    lake = _landed_legs(spark, sf_dir)
    tables, sources = _stored_sources(lake)
    lake.write("silver", SILVER, finish_silver(align_stored(spark, tables, LEG_TABLE, sources)))
    silver = lake.read("silver", SILVER)
    rows = source_log(lake.manifest("bronze"), silver, sources, RUN_TS).drop("run_ts")
    return rows.crossJoin(silver.agg(F.count("*").alias("silver_rows")))  # one row


@query(
    "manifest_discovery",
    """
    WITH landed AS (
        SELECT 'shipment_lead_time_' || year(o_orderdate) || '_q' || quarter(o_orderdate) || '_' || o_custkey AS table_name,
               max(o_orderkey) AS newest, count(*) AS landings,
               arg_max(o_orderpriority, o_orderkey) AS priority, arg_max(o_orderkey % 5, o_orderkey) AS kind,
               max(year(o_orderdate) * 10 + quarter(o_orderdate)) AS yq
        FROM orders GROUP BY 1
    )
    SELECT table_name, (yq // 10) || '_Q' || (yq % 10) AS period, newest AS rows,
           priority <> '5-LOW' AS has_columns, yq >= 19973 AND priority <> '5-LOW' AS is_source
    FROM landed WHERE kind <> 4
    """,
)
def manifest_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with a row per order and a table name per customer and quarter; the newest
    row of each table that is still there decides."""
    lake = _lake(spark, "manifest")
    day = F.col("o_orderdate")
    name = F.concat(
        F.lit("shipment_lead_time_"), F.year(day).cast("string"), F.lit("_q"), F.quarter(day).cast("string"),
        F.lit("_"), F.col("o_custkey").cast("string"),
    )
    complete = [group[-1] for group in LEG_TABLE.required_groups]
    columns = F.when(
        F.col("o_orderpriority") == "5-LOW", F.array(*[F.lit(c) for c in complete if c != "etd"])
    ).otherwise(F.array(*map(F.lit, complete)))
    # A table of which the newest landing is gone has its rows under another layer.
    gone = F.when(F.col("o_orderkey") % 5 == 4, "gone").otherwise("bronze")
    rows = read(spark, sf_dir, "orders").select(
        F.lit("bronze").alias("layer"), name.alias("table_name"), columns.alias("columns"),
        F.array_repeat(F.lit("string"), F.size(columns)).alias("types"), F.lit("{}").alias("schema"),
        gone.alias("run"), F.col("o_orderkey").alias("rows"),
        F.timestamp_seconds(F.lit(int(RUN_TS.timestamp())) + F.col("o_orderkey")).alias("landed_at"),
    )
    names = list(MANIFEST_COLUMNS)
    for third in range(3):
        lake.append(MANIFEST, rows.filter(F.col("rows") % 3 == third).select(*names))
    shown = ["table_name", "period", "rows", "has_columns", "is_source"]

    def judged(log: DataFrame) -> DataFrame:
        tables = classify_tables(log, LEG_TABLE.required_groups, first_period=(1997, 3))
        return tables.select(*shown, "landed_at", "run")

    return lake.newest("bronze", judged).filter("run <> 'gone'").select(*shown)


MANIFEST_COLUMNS = [part.split()[0] for part in MANIFEST_SCHEMA.split(", ")]


@query(
    "missing_column",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS etd, CAST(NULL AS VARCHAR) AS vessel,
           'whole' AS _source_period, 1 AS refused
    FROM orders
    """,
)
def missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without an optional column has NULLs, one without a required column is refused."""
    spec = TableSpec(
        columns=(
            ColumnSpec("o_orderkey", "bigint", ("o_orderkey",)),
            ColumnSpec("etd", "date", ("etd", "o_orderdate"), is_date=True),
            ColumnSpec("vessel", "string", ("vessel",), required=False),
        ),
        period_column=PERIOD,
        window_column="etd",
    )
    orders = read(spark, sf_dir, "orders")
    refused = 0
    try:
        align_all({"t": orders.drop("o_orderdate")}, spec, [SourceSpec("lacking", "t")])
    except MissingColumn:
        refused += 1
    return align_all({"t": orders}, spec, [SourceSpec("whole", "t")]).withColumn("refused", F.lit(refused))


# ---------------------------------------------------------------- landing outcomes


@query(
    "landing_outcomes",
    """
    WITH tabs AS (
        SELECT o_custkey % 40 AS file, month(o_orderdate) AS tab, count(*) AS n, max(o_orderkey) AS k
        FROM orders GROUP BY ALL
    ), files AS (
        SELECT *, max(CASE WHEN file % 7 = 3 AND tab = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY file) AS bad,
               count(*) FILTER (WHERE tab IN (5, 6)) OVER (PARTITION BY file) AS twins
        FROM tabs
    )
    SELECT 'file ' || file || '.xlsx' AS file_name,
           CASE tab WHEN 5 THEN 'Tab-5' WHEN 6 THEN 'tab 5' ELSE 'Tab ' || tab END AS tab,
           'file_' || file || '_tab_' || CASE tab WHEN 6 THEN 5 ELSE tab END AS table_name,
           CASE WHEN bad = 1 AND tab = 2 THEN 0 ELSE n END AS rows, 3 AS width,
           CASE WHEN bad = 1 AND tab = 2 THEN 'cannot be read'
                WHEN bad = 1 THEN 'its workbook is not readable'
                WHEN tab IN (5, 6) AND twins = 2 THEN 'several tabs land as file_' || file || '_tab_5' END AS reason
    FROM files
    """,
)
def landing_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as decoded rows of forty workbooks, some with an unreadable tab or two tabs of
    one name; what becomes of each tab."""
    orders = read(spark, sf_dir, "orders")
    file, tab = (F.col("o_custkey") % 40).cast("string"), F.month("o_orderdate")
    number = F.when(tab == 6, 5).otherwise(tab).cast("string")
    named = F.when(tab == 5, "Tab-5").when(tab == 6, "tab 5").otherwise(F.concat(F.lit("Tab "), tab.cast("string")))
    bad = ((F.col("o_custkey") % 40) % 7 == 3) & (tab == 2)
    cells = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority"))
    data = orders.select(
        F.concat(F.lit("in/file "), file, F.lit(".xlsx")).alias("path"),
        F.concat(F.lit("file "), file, F.lit(".xlsx")).alias("file_name"),
        named.alias("tab"),
        F.concat(F.lit("file_"), file, F.lit("_tab_"), number).alias("table"),
        (F.col("o_orderkey") + 2).alias("row_no"),
        cells.alias("cells"),
        F.when(bad, "cannot be read").alias("error"),
    )
    headers = data.groupBy("path", "file_name", "tab", "table").agg(F.max("error").alias("error")).withColumns({
        "row_no": F.lit(1).cast("bigint"), "cells": F.array(*map(F.lit, ["key", "status", "priority"])),
    })
    return judge_tabs(data.unionByName(headers)).drop("path", "first_row")


# ---------------------------------------------------------------- publishing


@query(
    "publish_all_or_none",
    """
    SELECT folder, s_suppkey, s_name, s_nationkey, s_acctbal, 2 AS refused
    FROM supplier, (VALUES ('finance'), ('operations')) t(folder)
    """,
)
def publish_all_or_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A newer table that one of two or three folders refuses: all keep the table they had."""
    lake = _lake(spark, "folders")
    suppliers = read(spark, sf_dir, "supplier")
    folders = {name: f"{lake.root}/{name}" for name in ("finance", "operations")}
    for folder in folders.values():
        publish.make_folder(spark, folder)
    source = lake.path("gold", "supplier")
    lake.write("gold", "supplier", suppliers)
    publish.copy_to_folders(spark, source, folders.values())
    lake.write("gold", "supplier", suppliers.unionAll(suppliers))
    # One folder is missing; then one has a file where the table's folder should be.
    blocked = f"{lake.root}/blocked"
    publish.make_folder(spark, blocked)
    publish.touch(spark, f"{blocked}/supplier")
    refused = 0
    for extra in (f"{lake.root}/missing", blocked):
        try:
            publish.copy_to_folders(spark, source, [*folders.values(), extra])
        except Exception:  # whatever the file system raises
            refused += 1
    copies = [
        publish.read_table(spark, f"{path}/supplier").select(F.lit(name).alias("folder"), "*")
        for name, path in folders.items()
    ]
    return reduce(DataFrame.unionByName, copies).withColumn("refused", F.lit(refused))


# ---------------------------------------------------------------- ranges and files


@query("erp_ranges", "SELECT c_custkey, c_name, c_nationkey, 1 AS parts FROM customer")
def erp_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers read in ranges of their name between cut points, and of their nation, of which
    some are unknown: every row comes once."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    some = customers.withColumn("n", F.nullif("c_nationkey", F.lit(7)))
    ranged = customers.repartitionByRange(16, "c_name").groupBy(F.spark_partition_id()).agg(F.min("c_name").alias("cut"))
    cuts = sorted(row["cut"] for row in ranged.collect())[1:]
    by_name = [c.replace("N'", "'") for c in range_conditions("c_name", cuts)]
    by_nation = range_conditions("n", [3, 3, 11, 20])
    met = lambda conditions: F.expr(" + ".join(f"int(coalesce({c}, false))" for c in conditions))
    parts = some.withColumns({"parts": met(by_name), "others": met(by_nation)})
    read_parts = [parts.filter(F.expr(condition)) for condition in by_nation]
    return reduce(DataFrame.unionByName, read_parts).filter("others = 1").select(
        "c_custkey", "c_name", "c_nationkey", "parts"
    )


@query(
    "clustered_files",
    """
    SELECT layout, count(*) AS rows, CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS first,
           CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last, layout = 'spread' AS overlaps
    FROM lineitem, (VALUES ('clustered'), ('spread')) t(layout) GROUP BY layout
    """,
)
def clustered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written by ship date and written anyhow: spans of the first table's files do
    not overlap, those of the second do."""
    lake = _lake(spark, "spans")
    items = read(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    lake.write("silver", "clustered", clustered(items, "day", "l_orderkey", "l_linenumber"))
    lake.write("silver", "spread", items.repartition(8, "l_orderkey"))
    reports = []
    for name in ("clustered", "spread"):
        lake.write("gold", f"{name}_files", file_spans(lake.read("silver", name), "day"))
        report = overlap_report(lake.read("gold", f"{name}_files"))
        reports.append(report.select(
            F.lit(name).alias("layout"), "rows", "first", "last", (F.col("overlapping") > 0).alias("overlaps")
        ))
    return reduce(DataFrame.unionByName, reports)


@query(
    "grain_by_files",
    """
    SELECT 'orders' AS "table", count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_keys,
           count(*) = count(DISTINCT o_orderkey) AS passed
    FROM orders
    UNION ALL
    SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), count(*) = count(DISTINCT l_orderkey) FROM lineitem
    UNION ALL
    SELECT 'unsorted', count(*), count(DISTINCT o_custkey), count(*) = count(DISTINCT o_custkey) FROM orders
    """,
)
def grain_by_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grain of two clustered tables from the borders of their sorted files, and of a table
    that is not sorted by its key."""
    lake = _lake(spark, "grain")
    orders, items = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    lake.write("silver", "orders", clustered(orders, "o_orderkey"))
    lake.write("silver", "lineitem", clustered(items, "l_orderkey", "l_linenumber"))
    lake.write("silver", "unsorted", orders.repartition(4, "o_orderkey"))
    gates = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("unsorted", "o_custkey")):
        table = lake.read("silver", name)
        lake.write("gold", f"{name}_runs", key_runs(table, key))
        gates.append(
            clustered_grain_gate(table, lake.read("gold", f"{name}_runs"), key).select(F.lit(name).alias("table"), "*")
        )
    return reduce(DataFrame.unionByName, gates)
