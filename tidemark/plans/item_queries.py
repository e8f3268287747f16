"""Queries for the item master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.numbers import price
from tidemark.functions.text import before_slash
from tidemark.operators import quality
from tidemark.operators.landing import land_text
from tidemark.plans.inputs import erp_tables, read
from tidemark.plans.items import (
    build_item_dimension,
    build_item_silver,
    enrich_items,
    item_report,
    item_size,
    one_per_sku,
    pairs_per_unit,
    type_items,
)
from tidemark.plans.registry import query

# One row per item and match: brands twice (with and without a name), the others at most once.
ENRICHED = """
    enriched AS (
        SELECT CAST(l.l_orderkey AS VARCHAR) AS sku,
               b.brand_name,
               CAST(l.l_suppkey AS VARCHAR) AS brand,
               'item ' || l.l_partkey AS style_name,
               CASE WHEN o.o_orderpriority <> '5-LOW' THEN CAST(o.o_custkey AS VARCHAR) END AS style,
               l.l_returnflag AS color_name,
               strftime(l.l_shipdate, '%y') || 'SP' AS year_season,
               CASE WHEN l.l_returnflag = 'A' THEN 'PK' || l.l_linenumber
                    WHEN o.o_orderpriority <> '5-LOW' THEN month(o.o_orderdate) || 'M' END AS size,
               NULLIF(o.o_orderpriority, '5-LOW') AS width,
               n.n_name AS category,
               r.r_name AS sub_category,
               CAST(CASE WHEN l.l_returnflag <> 'A' THEN 1
                         WHEN o.o_orderstatus <> 'P' THEN day(o.o_orderdate) END
                    AS DECIMAL(18,4)) AS pair_per_unit,
               'PK' || l.l_linenumber AS package,
               CASE WHEN p.p_size <= 25 THEN '00' || p.p_partkey END AS upc,
               CAST(l.l_extendedprice AS DECIMAL(17,2)) AS sales_price,
               CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2))
                          * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(17,2))
                   AS purchase_price,
               CASE WHEN l.l_returnflag = 'A' THEN 'CA' ELSE 'PR' END AS unit_of_measure
        FROM lineitem l
        LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
        LEFT JOIN part p ON p.p_partkey = l.l_partkey
        LEFT JOIN (SELECT s_suppkey, s_name AS brand_name FROM supplier
                   UNION ALL SELECT s_suppkey, NULL FROM supplier) b ON b.s_suppkey = l.l_suppkey
        LEFT JOIN nation n ON n.n_nationkey = l.l_linenumber
        LEFT JOIN region r ON r.r_regionkey = l.l_linenumber AND l.l_linenumber < 5
    )"""

COLUMNS = [name for name, _ in fixed.ITEM_COLUMNS]
AS_TEXT = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c in fixed.ITEM_NUMBERS else c for c in COLUMNS
)

# The kept row of a SKU: preferred columns first, the remaining ones settle ties.
TIES = [c for c in COLUMNS if c != "sku"]
KEPT = f"""
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY sku
            ORDER BY brand_name NULLS LAST, pair_per_unit NULLS LAST, upc NULLS LAST,
                     {', '.join(f'{c} NULLS LAST' for c in TIES)}) AS rn
        FROM enriched
    ),
    kept AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)"""


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_items(erp_tables(spark, sf_dir))


@query("item_enrich", f"WITH {ENRICHED} SELECT {AS_TEXT} FROM enriched")
def item_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six left joins, typed after landing as padded text."""
    return type_items(land_text(_enriched(spark, sf_dir)))


@query("item_fanout", f"WITH {ENRICHED}, {KEPT} SELECT {AS_TEXT} FROM kept")
def item_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups that fan items out, then one row per SKU."""
    return build_item_silver(land_text(_enriched(spark, sf_dir)))


DISPLAYED = ", ".join(
    f'CAST({c} AS VARCHAR) AS "{shown}"' if c in fixed.ITEM_NUMBERS else f'{c} AS "{shown}"'
    for c, shown in fixed.ITEM_COLUMNS
)


@query("dim_item", f"WITH {ENRICHED}, {KEPT} SELECT {DISPLAYED} FROM kept")
def dim_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item dimension end to end: joins, text, types, one per SKU, display names."""
    return build_item_dimension(build_item_silver(land_text(_enriched(spark, sf_dir))))


def _padded_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as an all-text item table with padding, blanks and repeated SKUs."""
    line = F.col("l_linenumber").cast("string")

    def padded(column: str) -> Column:
        return F.concat(F.lit("  "), F.col(column).cast("string"), F.lit(" "))

    values = {
        "sku": F.when(F.col("l_linenumber") == 7, "   ").otherwise(padded("l_orderkey")),
        "brand_name": F.when(F.col("l_returnflag") == "R", " ").otherwise(padded("l_returnflag")),
        "brand": padded("l_suppkey"),
        "style_name": padded("l_linestatus"),
        "upc": F.concat(F.lit("00"), line),
        "pair_per_unit": F.when(F.col("l_linestatus") == "O", F.concat(line, F.lit(".00005 "))),
        "sales_price": F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".125 ")),
        "purchase_price": F.concat(F.lit(" -"), line, F.lit("e2")),
    }
    return read(spark, sf_dir, "lineitem").select(*[
        values.get(name, F.lit(" ")).alias(name) for name in COLUMNS
    ])


PADDED = f"""
    padded AS (
        SELECT CASE WHEN l_linenumber <> 7 THEN CAST(l_orderkey AS VARCHAR) END AS sku,
               NULLIF(l_returnflag, 'R') AS brand_name, CAST(l_suppkey AS VARCHAR) AS brand,
               l_linestatus AS style_name, '00' || l_linenumber AS upc,
               CASE WHEN l_linestatus = 'O' THEN CAST(l_linenumber + 0.0001 AS DECIMAL(18,4)) END
                   AS pair_per_unit,
               CAST(l_quantity + 0.13 AS DECIMAL(17,2)) AS sales_price,
               CAST(-100 * l_linenumber AS DECIMAL(17,2)) AS purchase_price
        FROM lineitem
    ),
    enriched AS (
        SELECT {', '.join(c if c in (
            'sku', 'brand_name', 'brand', 'style_name', 'upc', 'pair_per_unit', 'sales_price',
            'purchase_price') else f'CAST(NULL AS VARCHAR) AS {c}' for c in COLUMNS)}
        FROM padded
    )"""


@query("item_typed", f"WITH {PADDED} SELECT {AS_TEXT} FROM enriched")
def item_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_items(_padded_items(spark, sf_dir))


@query(
    "item_one_per_key",
    f"WITH {PADDED}, {KEPT} SELECT {AS_TEXT} FROM kept WHERE sku IS NOT NULL",
)
def item_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_sku(type_items(_padded_items(spark, sf_dir)))


@query(
    "price_round",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                           * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
                AS DECIMAL(17,2)) AS VARCHAR) AS net_price,
           CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(-0.125 AS DECIMAL(4,3)), 2)
                AS DECIMAL(17,2)) AS VARCHAR) AS eighth
    FROM lineitem
    """,
)
def price_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        price(amount * (1 - discount)).alias("net_price"),
        price(amount * F.lit(-0.125).cast("decimal(4,3)")).alias("eighth"),
    )


@query(
    "item_case_logic",
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'A' THEN 'PK' || l_linenumber
                WHEN l_linestatus = 'O' THEN 'L' || l_suppkey END AS size,
           CASE WHEN l_returnflag <> 'A' THEN '1.0000'
                WHEN l_linestatus = 'O' THEN CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR) END
               AS pairs
    FROM lineitem
    """,
)
def item_case_logic(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber").cast("string")
    open_line = F.col("l_linestatus") == "O"
    size = F.concat(F.lit("L"), F.col("l_suppkey").cast("string"), F.lit("  "))
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "A", "CA  ").otherwise("PR  ").alias("unit"),
        F.concat(F.lit("PK"), line, F.lit(" ")).alias("package"),
        F.when(open_line, size).alias("matrix_size"),
        F.when(open_line, F.col("l_quantity").cast("decimal(15,9)")).alias("factor"),
    )
    return items.select(
        "l_orderkey",
        "l_linenumber",
        item_size("unit", "package", "matrix_size").alias("size"),
        pairs_per_unit("unit", "factor").alias("pairs"),
    )


@query(
    "name_prefix",
    """
    SELECT c_custkey, split_part(c_name, '#', 1) AS prefix,
           c_mktsegment AS whole, '' AS empty
    FROM customer
    """,
)
def name_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.translate("c_name", "#", "/")
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        before_slash(F.concat(name, F.lit("/more"))).alias("prefix"),
        before_slash(F.col("c_mktsegment")).alias("whole"),
        before_slash(F.concat(F.lit("/"), name)).alias("empty"),
    )


REPEATS = f"""
    WITH {PADDED}, repeats AS (
        SELECT sku, count(*) AS row_count FROM padded WHERE sku IS NOT NULL
        GROUP BY sku HAVING count(*) > 1)
    """


@query(
    "report_item",
    REPEATS
    + """
    SELECT count(*) AS bronze_rows, count(*) FILTER (WHERE sku IS NULL) AS blank_rows,
           count(DISTINCT sku) AS silver_rows,
           (SELECT count(*) FROM repeats) AS repeated_keys,
           (SELECT CAST(sum(row_count - 1) AS BIGINT) FROM repeats) AS dropped_rows
    FROM padded
    """,
)
def report_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_report(_padded_items(spark, sf_dir))


@query(
    "report_repeats",
    REPEATS + "SELECT sku, row_count FROM repeats ORDER BY row_count DESC, sku LIMIT 10",
)
def report_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most repeated SKUs."""
    return quality.repeat_report(_padded_items(spark, sf_dir), "sku", top=10)
