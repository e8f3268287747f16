"""The driver's tables in the shapes the operators read.

Bronze lead-time tables come from line items: one table per year, each in the layout a
quarterly template had, with renamed, missing and mislabelled columns and mixed types.
ERP tables come from line items, orders, parts, suppliers, nations and regions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.dates import DAYS, MONTHS, YEARS, part_text
from tidemark.functions.text import code_text
from tidemark.operators.drift import SourceSpec
from tidemark.session import limit_methods

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

FIRST_PERIOD = (2000, 3)

# Hand-mapped yearly tables: half-open windows on etd.
MAPPED = [
    SourceSpec("1995", "shipment_lead_time_1995_data", None, date(1996, 1, 1)),
    SourceSpec("1996_Q1", "shipment_lead_time_1996_q1_data", date(1996, 1, 1), date(1997, 1, 1)),
    SourceSpec("1997_Q2", "shipment_lead_time_1997_q2_data", date(1997, 1, 1), date(1998, 1, 1)),
    SourceSpec("1998_Q4", "shipment_lead_time_1998_q4_data", date(1998, 1, 1), date(1999, 1, 1)),
    SourceSpec("1999_Q2", "shipment_lead_time_1999_q2_data", date(1999, 1, 1), date(2000, 1, 1)),
]

# Table, template, and the ship dates it holds; None is open, and a table that is open at
# its end also holds the line items without a date.  Neighbours overlap by a month.
CONTENTS = [
    ("shipment_lead_time_1995_data", 1, None, "1996-02-01"),
    ("shipment_lead_time_1996_q1_data", 2, "1995-12-01", "1997-02-01"),
    ("shipment_lead_time_1997_q2_data", 3, "1996-12-01", "1998-02-01"),
    ("shipment_lead_time_1998_q4_data", 4, "1997-12-01", "1999-02-01"),
    ("shipment_lead_time_1999_q2_data", 5, "1998-12-01", "2000-02-01"),
    ("shipment_lead_time_2000_q3_q3_2000", 6, "2000-01-01", "2001-02-01"),
    ("shipment_lead_time_2001_q1_data", 6, "2001-01-01", None),
    ("copy_of_shipment_lead_time_2001_q1_data", 6, "2001-01-01", None),
    ("shipment_lead_time_2000_q4_summary", 6, "2000-01-01", "2001-01-01"),
]

# This table pads its warehouse, so legs that the table before it holds too have other keys
# until they are normalized.
RESENT = "shipment_lead_time_2001_q1_data"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Columns that tell the rows of a table apart, to spread them by; a dedup on them needs no
# further exchange.
SPREAD_BY = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"]}


def read_spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """:func:`read`, with the rows of a file too small to split spread over the cores.

    The test tables are one row group each, so a scan is one task, and so would be all
    per-row work after it.  A table with a split per core is left as it is.
    """
    table = read(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores, *SPREAD_BY[name])


def _days(days: int) -> Column:
    return F.col("l_shipdate") + F.expr(f"interval {days} days")


def _hundredths(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("int").cast("double")


def _leg_columns() -> dict[str, Column]:
    """A leg's raw values, still typed, from one line item."""
    flag = F.col("l_returnflag")
    order = F.col("l_orderkey").cast("string")
    line = F.col("l_linenumber").cast("string")
    return {
        "wh": F.when(flag == "A", F.concat(F.lower("l_linestatus"), F.lit(" "))).otherwise(
            F.col("l_linestatus")
        ),
        "asn": F.col("l_orderkey"),
        "folio": F.concat(F.lit(" "), line),
        "b_l": F.concat(F.lit("BL"), order),
        "port": F.when(flag == "A", "Hochiminh")
        .when(flag == "N", " SEKOU ")
        .otherwise("nhava  sheva,\tIN"),
        "container": F.concat(F.lit("C"), line),
        "region": F.when(flag == "A", "China ").when(flag == "N", "CHINA").otherwise(" "),
        "min_req": _days(-10),
        "max_req": _days(10),
        "xfty_range": _hundredths("l_discount"),
        "xfty_to_container_consolidation": _days(-5),
        "pos_consolidation_to_gate_in": _hundredths("l_tax"),
        "gate_in": F.when(~((flag == "R") & (F.col("l_linestatus") == "F")), _days(-3)),
        "gate_in_to_etd": F.col("l_quantity"),
        "etd": F.trunc(F.col("l_shipdate").cast("date"), "month").cast("timestamp_ntz"),
        "etd_to_eta": F.col("l_linenumber").cast("double"),
        "eta": _days(20),
        "eta_to_delivery": F.col("l_quantity") + 1,
        "p_u": F.when(~((flag == "A") & (F.col("l_linestatus") == "O")), _days(25)),
        "delivery_to_received": F.col("l_quantity") + 2,
        "asn_receive": _days(30),
        "min_xft": F.col("l_quantity"),
        "max_xft": F.col("l_extendedprice"),
        "avg_xfty_to_received": F.col("l_quantity") + 3,
        # Noon UTC of the ship date, whatever the session's time zone.
        "_bronze_insert_ts": F.timestamp_seconds(
            F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * 86400 + 43200
        ),
        "_source_file_name": F.concat(F.lit("lead time "), flag, F.lit(".xlsx")),
    }


def _day_form(day: Column, form: str) -> Column:
    """``date_format``, for two forms without its formatter where the year is in YEARS."""
    slow, year = F.date_format(day, form), part_text(F.year(day), YEARS, "%d")
    if form == "M/d/yyyy":
        parts = [part_text(F.month(day), MONTHS, "%d"), part_text(F.dayofmonth(day), DAYS, "/%d/"), year]
    elif form == "MM-dd-yyyy":
        parts = [part_text(F.month(day), MONTHS, "%02d"), part_text(F.dayofmonth(day), DAYS, "-%02d-"), year]
    else:
        return slow
    return F.coalesce(F.concat(*parts), slow)


def _template(leg: dict[str, Column], template: int) -> dict[str, Column]:
    """The columns of one template, under the names and in the formats it used."""
    passed = [
        "asn", "folio", "b_l", "port", "container", "region",
        "xfty_to_container_consolidation", "pos_consolidation_to_gate_in",
        "gate_in_to_etd", "etd_to_eta", "eta_to_delivery", "delivery_to_received",
        "avg_xfty_to_received", "_bronze_insert_ts", "_source_file_name",
    ]
    table = {name: leg[name] for name in passed}

    def text(name: str, form: str, missing: str = "") -> Column:
        return F.coalesce(_day_form(leg[name], form), F.lit(missing))

    table["wh" if template < 5 else "whr"] = leg["wh"]
    table["min_max_xfty" if template < 3 else "max_min_xfty"] = leg["xfty_range"]
    swapped = template < 3
    table["min_xft_to_received"] = leg["max_xft"] if swapped else leg["min_xft"]
    table["max_xft_to_received"] = leg["min_xft"] if swapped else leg["max_xft"]
    if template < 4:
        size = F.concat(F.col("l_linenumber").cast("string"), F.lit("h "))
        table["continer_size" if template < 3 else "container_size"] = size
        table["div"] = F.lower("l_returnflag")
        table["vessel"] = F.concat(F.lit(" V"), F.col("l_suppkey").cast("string"))
    if template < 3:
        table["customer"] = F.concat(F.lit(" cust "), F.col("l_suppkey").cast("string"))
        table["asn_qty"] = F.col("l_quantity")
    for end in ("min", "max"):
        if template < 5:
            table[f"{end}_of_po_head_req_delivery_date"] = leg[f"{end}_req"]
        else:
            form = "MM-dd-yyyy" if template == 5 else "M/d/yyyy"
            table[f"{end}_header_delivery_date"] = text(f"{end}_req", form)
    if template == 2:
        table["asn"] = leg["asn"].cast("double")
    table["gate_in"] = text("gate_in", "yyyy-MM-dd", "TBD") if template == 2 else leg["gate_in"]
    table["p_u"] = text("p_u", "yyyy-MM-dd HH:mm:ss")
    if template == 1:
        # Two digits stand for a year of this or the last century only.
        near = F.year(leg["p_u"]).between(1969, 2068)
        table["p_u"] = F.when(near, text("p_u", "M/d/yy")).otherwise(text("p_u", "M/d/yyyy"))
    table["asn_receive"] = (
        text("asn_receive", "MM-dd-yyyy") if template == 5 else leg["asn_receive"]
    )
    table["eta" if template == 6 else "current_eta_port"] = leg["eta"]
    unknown = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7)
    table["etd"] = (
        F.when(unknown, "TBD").otherwise(text("etd", "M/d/yyyy")) if template == 6 else leg["etd"]
    )
    return table


MOST_PARTITIONS = 1 << 20  # no scan has more


def bronze_legs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Drifted Bronze tables that together hold every line item."""
    limit_methods(spark)
    items = read(spark, sf_dir, "lineitem")
    shipped, day = F.col("l_shipdate"), "timestamp_ntz"
    leg = _leg_columns()
    tables = {}
    for name, template, first, end in CONTENTS:
        held = F.lit(True) if first is None else shipped >= F.lit(first).cast(day)
        held = held | shipped.isNull() if end is None else held & (shipped < F.lit(end).cast(day))
        # Changes no partition: scan and filter are compiled apart from projections too long for it.
        part = items.filter(held).coalesce(MOST_PARTITIONS)
        columns = _template(leg, template)
        if name == RESENT:
            columns["whr"] = F.concat("l_linestatus", F.lit(" "))
        tables[name] = part.select(*[value.alias(column) for column, value in columns.items()])
    # A summary tab has too few columns to be a source, whatever its name.
    summary = "shipment_lead_time_2000_q4_summary"
    tables[summary] = tables[summary].select("whr", "asn", "etd")
    return tables


def order_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as Silver legs: the columns the star schema reads, some of them NULL."""
    priority = F.col("o_orderpriority")
    price = F.col("o_totalprice")
    return read_spread(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("wh"),
        F.col("o_orderkey").cast("string").alias("asn"),
        priority.alias("folio"),
        F.when(priority != "3-MEDIUM", code_text(priority)).alias("port"),
        F.when(priority != "5-LOW", F.col("o_orderdate").cast("date")).alias("asn_receive"),
        F.nullif("o_orderstatus", F.lit("P")).alias("region"),
        price.alias("avg_xfty_to_received"),
        F.when(price > 100000, price).alias("min_xft_to_received"),
        (price + 1).alias("max_xft_to_received"),
        F.col("o_custkey").cast("double").alias("delivery_to_received"),
        F.lit(None).cast("double").alias("eta_to_delivery"),
        F.dayofmonth("o_orderdate").cast("double").alias("etd_to_eta"),
        F.when(priority == "1-URGENT", 1.0).alias("gate_in_to_etd"),
        F.month("o_orderdate").cast("double").alias("pos_consolidation_to_gate_in"),
        F.quarter("o_orderdate").cast("double").alias("xfty_range"),
    )


def erp_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """ERP base tables: several item rows per SKU, padded keys, a brand table that
    repeats each brand per division."""
    items = read_spread(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders")
    parts = read(spark, sf_dir, "part")
    suppliers = read(spark, sf_dir, "supplier")
    company = F.lit(1)

    def padded(column: Column | str, width: int = 15) -> Column:
        return F.rpad(F.col(column).cast("string") if isinstance(column, str) else column, width, " ")

    flag = F.col("l_returnflag")
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    unit = F.when(flag == "A", "CA").otherwise("PR")
    base = items.select(
        company.alias("MMCONO"),
        padded("l_orderkey").alias("MMITNO"),
        padded("l_partkey", 12).alias("MMITNE"),
        padded("l_suppkey", 8).alias("MMITCL"),
        F.concat(F.lit("item "), F.col("l_partkey").cast("string"), F.lit("/"), flag).alias("MMITDS"),
        padded(flag, 5).alias("MMSPE4"),
        F.concat(F.lit(" "), F.date_format("l_shipdate", "yy"), F.lit("SP ")).alias("MMCFI1"),
        padded(unit, 4).alias("MMUNMS"),
        F.concat(F.lit("PK"), F.col("l_linenumber").cast("string"), F.lit(" ")).alias("MMSPAC"),
        padded("l_linenumber", 6).alias("MMGRP1"),
        F.when(F.col("l_linenumber") < 5, F.col("l_linenumber").cast("string"))
        .otherwise("  ").alias("MMGRP3"),
        amount.alias("MMSAPR"),
        (amount * (1 - discount)).alias("MMPUPR"),
    )
    units = orders.select(
        company.alias("MUCONO"),
        padded("o_orderkey", 20).alias("MUITNO"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("MUAUS9"),
        F.lit(2).alias("MUAUTP"),
        F.dayofmonth("o_orderdate").cast("decimal(15,9)").alias("MUCOFA"),
    )
    matrix = orders.filter("o_orderpriority <> '5-LOW'").select(
        company.alias("HMCONO"),
        F.col("o_orderkey").cast("string").alias("HMITNO"),
        padded("o_custkey").alias("HMSTYN"),
        F.concat(F.month("o_orderdate").cast("string"), F.lit("M ")).alias("HMOPTX"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("HMOPTY"),
    )
    aliases = parts.select(
        company.alias("MPCONO"),
        F.col("p_partkey").cast("string").alias("MPITNO"),
        F.when(F.col("p_size") > 25, 3).otherwise(2).alias("MPALWT"),
        F.lit("UPC  ").alias("MPALWQ"),
        F.concat(F.lit("00"), F.col("p_partkey").cast("string"), F.lit(" ")).alias("MPPOPN"),
    )
    brand = suppliers.select(
        company.alias("CTCONO"),
        F.explode(F.array(F.lit("ITCL "), F.lit("ITCL"), F.lit("OTHR"))).alias("CTSTCO"),
        F.col("s_suppkey").cast("string").alias("CTSTKY"),
        F.col("s_name"),
    )
    brands = brand.select(
        "CTCONO", "CTSTCO", "CTSTKY",
        F.when(F.col("CTSTCO") != "ITCL", F.concat("s_name", F.lit(" "))).alias("CTTX15"),
    )
    nations = read(spark, sf_dir, "nation").select(
        company.alias("SGCONO"),
        F.lit(fixed.CATEGORY_LEVEL).alias("SGGLVL"),
        F.col("n_nationkey").cast("string").alias("SGSGP0"),
        F.concat("n_name", F.lit(" ")).alias("SGTX40"),
    )
    regions = read(spark, sf_dir, "region").select(
        company.alias("SGCONO"),
        F.lit(fixed.SUB_CATEGORY_LEVEL).alias("SGGLVL"),
        F.col("r_regionkey").cast("string").alias("SGSGP0"),
        F.concat("r_name", F.lit(" ")).alias("SGTX40"),
    )
    return {
        "MITMAS": base,
        "MITAUN": units,
        "MITMAH": matrix,
        "MITPOP": aliases,
        "CSYTAB": brands,
        "MITSCH": nations.unionByName(regions),
    }
