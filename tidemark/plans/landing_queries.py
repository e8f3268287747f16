"""Queries for sources, landing, catalog and publishing."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import table_name
from tidemark.operators import publish
from tidemark.operators.drift import classify_tables
from tidemark.operators.landing import (
    clean_headers,
    drop_blank_rows,
    drop_stray_rows,
    land_text,
    stamp,
)
from tidemark.operators.reshape import cells_to_table
from tidemark.plans.inputs import TABLES, read
from tidemark.plans.leadtime import LEG_TABLE
from tidemark.plans.registry import query
from tidemark.sources.erp import one_company
from tidemark.sources.files import file_manifest
from tidemark.sources.lake import Lake, catalog_tables, work_folder

RUN_TS = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


@query(
    "header_normalize",
    """
    SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand,
           p_type AS type_kind, p_size AS size_cm, p_retailprice AS retail_price
    FROM part
    """,
)
def header_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = [" Part Key# ", "Part--Name", "BRAND", "Type/Kind", "Size (cm)", "_Retail  Price_"]
    return clean_headers(read(spark, sf_dir, "part").toDF(*messy))


@query(
    "table_names",
    r"""
    SELECT c_custkey,
           trim(regexp_replace(lower('  Été ' || c_name || ' (' || c_mktsegment || ').Q' || c_nationkey || '-'),
                               '[^\p{L}\p{N}_]+', '_', 'g'), '_') AS table_name
    FROM customer
    """,
)
def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(
        F.lit("  Été "), "c_name", F.lit(" ("), "c_mktsegment", F.lit(").Q"),
        F.col("c_nationkey").cast("string"), F.lit("-"),
    )
    return read(spark, sf_dir, "customer").select("c_custkey", table_name(name).alias("table_name"))


@query(
    "cells_to_table",
    """
    SELECT o_orderkey AS row_no, CAST(o_custkey AS VARCHAR) AS cust, o_orderstatus AS status,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
           NULLIF(o_orderpriority, '5-LOW') AS priority
    FROM orders
    """,
)
def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = ["cust", "status", "price", "priority"]
    texts = F.array(
        F.col("o_custkey").cast("string"),
        F.col("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.nullif("o_orderpriority", F.lit("5-LOW")),
    )
    long = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_no"), F.posexplode(texts).alias("col_no", "text")
    )
    return cells_to_table(long, ["row_no"], "col_no", "text", headers)


def _customers_with_strays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, a blank row for each, and a row with only the segment for each."""
    customers = read(spark, sf_dir, "customer")
    blank = customers.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in customers.schema])
    only_segment = customers.select(*[
        (F.col(f.name) if f.name == "c_mktsegment" else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in customers.schema
    ])
    return customers.unionByName(blank).unionByName(only_segment)


@query(
    "blank_row_drop",
    """
    SELECT * FROM customer
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, c_mktsegment FROM customer
    """,
)
def blank_row_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_blank_rows(_customers_with_strays(spark, sf_dir))


@query(
    "partial_row_drop",
    """
    SELECT * FROM customer
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL FROM customer
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
    """,
)
def partial_row_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_stray_rows(_customers_with_strays(spark, sf_dir), "c_mktsegment", "BUILDING")


@query(
    "land_text",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           o_orderstatus,
           CASE WHEN o_totalprice = floor(o_totalprice)
                THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR)
                ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM orders
    """,
)
def all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land_text(read(spark, sf_dir, "orders"))


@query(
    "lineage_stamp",
    f"""
    SELECT o_orderkey, CAST({int(RUN_TS.timestamp()) * 1_000_000} AS BIGINT) AS _bronze_insert_ts,
           'orders.parquet' AS _source_file_name
    FROM orders
    """,
)
def lineage_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "_metadata.file_name")
    return stamp(orders, RUN_TS, F.col("file_name")).drop("file_name")


@query(
    "file_manifest",
    """
    SELECT 'customer.parquet' AS file_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'conversations.parquet', count(*) FROM conversations
    UNION ALL SELECT 'orders.parquet', count(*) FROM orders
    UNION ALL SELECT 'supplier.parquet', count(*) FROM supplier
    """,
)
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files selected by keyword, each with the rows it holds."""
    files = file_manifest(spark, sf_dir, "ER", "*.parquet").filter("file_size > 0")
    counts = [
        read(spark, sf_dir, row.file_name.removesuffix(".parquet")).select(
            F.lit(row.file_name).alias("file_name")
        ).groupBy("file_name").agg(F.count("*").alias("row_count"))
        for row in files.select("file_name").collect()
    ]
    return reduce(DataFrame.unionByName, counts)


# Column lists of the driver's tables.
COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


@query(
    "catalog_columns",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, unnest([{', '.join(repr(c) for c in names.split())}])"
        f" AS column_name, unnest([{', '.join(f'count({c})' for c in names.split())}]) AS filled"
        f" FROM {table}"
        for table, names in COLUMNS.items()
    ),
)
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every table that the catalog lists under a name, with its filled values."""
    prefix = f"listed_{uuid.uuid4().hex}_"
    for name in TABLES:
        read(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
    try:
        listed = catalog_tables(spark, "default", f"{prefix}*").collect()
    finally:
        for name in TABLES:
            spark.catalog.dropTempView(prefix + name)
    profiles = []
    for row in listed:
        name = row.table_name.removeprefix(prefix)
        filled = read(spark, sf_dir, name).toDF(*row.columns).agg(*[F.count(c).alias(c) for c in row.columns])
        profiles.append(
            filled.unpivot([], row.columns, "column_name", "filled").select(
                F.lit(name).alias("table_name"), "column_name", "filled"
            )
        )
    return reduce(DataFrame.unionByName, profiles)


@query("company_scan", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey = 7")
def company_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return one_company(customers, "c_nationkey", 7)


@query(
    "period_discovery",
    """
    WITH named AS (
        SELECT year(o_orderdate) AS y,
               CASE o_orderstatus WHEN 'P' THEN 5 ELSE quarter(o_orderdate) END AS q,
               o_orderpriority AS p, month(o_orderdate) <= 6 AS full_columns
        FROM orders
    ), grouped AS (
        SELECT CASE p WHEN '5-LOW' THEN 'copy_of_' ELSE '' END
                 || 'shipment_lead_time_' || y || '_q' || q
                 || CASE p WHEN '2-HIGH' THEN '_summary'
                           WHEN '3-MEDIUM' THEN '_old_version_do_not_use'
                           ELSE '_data' END AS table_name,
               y, q, full_columns, p IN ('5-LOW', '2-HIGH', '3-MEDIUM') AS is_excluded,
               count(*) AS orders
        FROM named GROUP BY ALL
    )
    SELECT table_name,
           CASE WHEN q <= 4 THEN y || '_Q' || q END AS period,
           is_excluded, full_columns AS has_columns,
           q <= 4 AND (y, q) >= (1998, 3) AND NOT is_excluded AND full_columns AS is_source,
           orders
    FROM grouped
    """,
)
def period_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table names and columns made from orders, judged as lead-time sources."""
    priority = F.col("o_orderpriority")
    quarter = F.when(F.col("o_orderstatus") == "P", 5).otherwise(F.quarter("o_orderdate"))
    suffix = (
        F.when(priority == "2-HIGH", "_summary")
        .when(priority == "3-MEDIUM", "_old_version_do_not_use")
        .otherwise("_data")
    )
    name = F.concat(
        F.when(priority == "5-LOW", "copy_of_").otherwise(""),
        F.lit("shipment_lead_time_"), F.year("o_orderdate").cast("string"),
        F.lit("_q"), quarter.cast("string"), suffix,
    )
    complete = [group[-1] for group in LEG_TABLE.required_groups]
    lacking = [c for c in complete if c != "etd"]
    columns = F.when(F.month("o_orderdate") <= 6, F.array(*map(F.lit, complete))).otherwise(
        F.array(*map(F.lit, lacking))
    )
    listing = (
        read(spark, sf_dir, "orders")
        .select(name.alias("table_name"), columns.alias("columns"))
        .groupBy("table_name", "columns")
        .agg(F.count("*").alias("orders"))
    )
    judged = classify_tables(listing, LEG_TABLE.required_groups, first_period=(1998, 3))
    return judged.select(
        "table_name", "period", "is_excluded", "has_columns", "is_source", "orders"
    )


def _run_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}_{uuid.uuid4().hex}"


@query("export_roundtrip", "SELECT * FROM orders")
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice over through staging and count check, read back."""
    lake = Lake(spark, _run_folder(spark, "export"))
    lake.create_layers()
    orders = read(spark, sf_dir, "orders")
    for _ in range(2):
        lake.write("gold", "orders", orders, allow_empty=False)
    return lake.read("gold", "orders")


@query(
    "publish_targets",
    "SELECT f AS folder, c.* FROM customer c, (VALUES ('finance'), ('operations')) t(f)",
)
def publish_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exported table copied to two folders, both read back."""
    root = _run_folder(spark, "publish")
    lake = Lake(spark, root)
    lake.create_layers()
    lake.write("gold", "customer", read(spark, sf_dir, "customer"))
    folders = {name: f"{root}/{name}" for name in ("finance", "operations")}
    for folder in folders.values():
        publish.make_folder(spark, folder)
    publish.copy_to_folders(spark, lake.path("gold", "customer"), folders.values())
    copies = [
        publish.read_table(spark, f"{path}/customer").select(F.lit(name).alias("folder"), "*")
        for name, path in folders.items()
    ]
    return reduce(DataFrame.unionByName, copies)


@query("empty_extract_kept", "SELECT * FROM supplier")
def empty_extract_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that an empty extract and a failing check were meant to replace, read back."""
    lake = Lake(spark, _run_folder(spark, "kept"))
    lake.create_layers()
    suppliers = read(spark, sf_dir, "supplier")
    lake.write("gold", "supplier", suppliers, allow_empty=False)

    def refuse(table: DataFrame) -> None:
        raise publish.PublishError(f"{table.count()} rows are not wanted")

    refused = 0
    for extract, check in ((suppliers.limit(0), None), (suppliers.unionAll(suppliers), refuse)):
        try:
            lake.write("gold", "supplier", extract, allow_empty=False, check=check)
        except (publish.EmptyExtract, publish.PublishError):
            refused += 1
    return lake.read("gold", "supplier").filter(F.lit(refused) == 2)


@query("preview", "SELECT * FROM events ORDER BY event_id LIMIT 100")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").orderBy("event_id").limit(100)
