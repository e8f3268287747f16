"""ERP tables to item dimension."""

import json
import os
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.__main__ import main
from tidemark.operators.publish import EmptyExtract
from tidemark.operators.quality import DataQualityError, enforce, grain_gate
from tidemark.plans.items import (
    BRONZE,
    GOLD,
    SILVER,
    build_item_dimension,
    build_item_silver,
    enrich_items,
    item_report,
    run_item_master,
)
from tidemark.operators import publish
from tidemark.sources.erp import JdbcErp, ParquetErp, one_company, read_erp
from tidemark.sources.lake import Lake

TS = datetime(2026, 1, 2, tzinfo=timezone.utc)

SCHEMAS = {
    "MITMAS": "MMCONO int, MMITNO string, MMITNE string, MMITCL string, MMITDS string, "
    "MMSPE4 string, MMCFI1 string, MMUNMS string, MMSPAC string, MMGRP1 string, MMGRP3 string, "
    "MMSAPR decimal(17,6), MMPUPR decimal(17,6), MMFACI string",
    "MITAUN": "MUCONO int, MUITNO string, MUAUS9 int, MUAUTP int, MUCOFA decimal(15,9)",
    "MITMAH": "HMCONO int, HMITNO string, HMSTYN string, HMOPTX string, HMOPTY string",
    "MITPOP": "MPCONO int, MPITNO string, MPALWT int, MPALWQ string, MPPOPN string",
    "CSYTAB": "CTCONO int, CTSTCO string, CTSTKY string, CTTX15 string",
    "MITSCH": "SGCONO int, SGGLVL int, SGSGP0 string, SGTX40 string",
}


def item(company, sku, unit="PR ", description="ABC/red", alias=None, price="1.005", **more):
    return (
        company, f"{sku}   ", f"{alias or sku} ", "B1  ", description, "Red  ", " 25SP ", unit,
        "P12 ", "G1 ", more.get("group3", " "), Decimal(price), Decimal("2.345"), "F1",
    )


TABLES = {
    "MITMAS": [
        item(1, "S1"),
        item(2, "S1", description="other company"),
        item(1, "CASE1", unit="CA", description="/red"),
        item(1, "CASE2", unit="CA ", description="ABC", alias="S1"),
        item(1, "STYLE", group3="G3"),
        item(1, "  "),
    ],
    "MITAUN": [
        (1, "CASE1", 1, 2, Decimal(12)),
        (1, "S1", 1, 2, Decimal(99)),
        (1, "CASE2", 0, 2, Decimal(7)),
        (1, "CASE2", 1, 1, Decimal(8)),
        (2, "CASE2", 1, 2, Decimal(9)),
    ],
    "MITMAH": [(1, "S1 ", " ST1 ", "9.5  ", " M "), (1, "CASE1", "ST2", "10", "W")],
    "MITPOP": [
        (1, "S1", 2, "UPC   ", "0012 "),
        (1, "CASE1", 2, "EAN", "777"),
        (1, "STYLE", 1, "UPC", "888"),
    ],
    "CSYTAB": [
        (1, "ITCL  ", "B1", " Brand One "),
        (1, "ITCL", "B1 ", None),
        (1, "OTHR", "B1", "wrong"),
        (2, "ITCL", "B1", "Brand Two"),
    ],
    "MITSCH": [(1, 1, "G1", "Shoes  "), (1, 3, "G3  ", "Boots"), (1, 2, "G1", "wrong")],
}


@pytest.fixture
def erp(spark, folder):
    for name, rows in TABLES.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(f"{folder}/erp/{name}")
    return ParquetErp(folder + "/erp")


def test_only_needed_columns_of_one_company_are_read(spark, erp):
    tables = read_erp(spark, erp, 1)
    assert tables["MITMAS"].columns == fixed.ERP_COLUMNS["MITMAS"]
    plan = tables["MITMAS"]._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(MMCONO,1)" in plan and "MMFACI" not in plan
    assert tables["MITMAS"].count() == 5


@pytest.mark.parametrize("broadcast_bytes", [1 << 30, -1])
def test_enriched_items(spark, erp, broadcast_bytes):
    rows = enrich_items(read_erp(spark, erp, 1), broadcast_bytes).collect()
    assert len(rows) == 10  # the brand table has two rows for the brand
    by_sku = {r.sku: r for r in rows if r.brand_name is not None}
    shoe, case, bare, style = (by_sku[s] for s in ("S1", "CASE1", "CASE2", "STYLE"))
    assert shoe.brand_name == "Brand One" and shoe.brand == "B1  "
    assert (shoe.style_name, case.style_name, bare.style_name) == ("ABC", "", "ABC")
    assert (shoe.style, shoe.width, shoe.year_season) == ("ST1", "M", "25SP")
    assert (shoe.size, case.size, bare.size, style.size) == ("9.5", "P12", "P12", None)
    assert (shoe.pair_per_unit, case.pair_per_unit) == (Decimal("1.0000"), Decimal("12.0000"))
    assert bare.pair_per_unit is None and style.pair_per_unit == Decimal("1.0000")
    assert (shoe.upc, bare.upc, case.upc, style.upc) == ("0012 ", "0012 ", None, None)
    assert (shoe.category, shoe.sub_category, style.sub_category) == ("Shoes", None, "Boots")
    assert (shoe.sales_price, shoe.purchase_price) == (Decimal("1.01"), Decimal("2.35"))
    assert shoe.unit_of_measure == "PR " and shoe.package == "P12 "


def test_whole_run(spark, erp, folder):
    lake = Lake(spark, folder + "/lake")
    os.mkdir(folder + "/finance")
    counts = run_item_master(lake, erp, 1, TS, [folder + "/finance"])
    assert counts == {BRONZE: 10, SILVER: 4, GOLD: 4}
    bronze = lake.read("bronze", BRONZE)
    assert {t for _, t in bronze.drop("_bronze_insert_ts").dtypes} == {"string"}
    assert item_report(bronze).first().asDict() == {
        "bronze_rows": 10, "blank_rows": 2, "silver_rows": 4, "repeated_keys": 4, "dropped_rows": 4,
    }
    silver = lake.read("silver", SILVER)
    types = dict(silver.dtypes)
    assert types["pair_per_unit"] == "decimal(18,4)" and types["sales_price"] == "decimal(17,2)"
    assert silver.filter("brand_name IS NULL").isEmpty()
    assert silver.filter("sku = 'S1'").first().upc == "0012"
    dimension = publish.read_table(spark, folder + "/finance/" + GOLD)
    assert dimension.columns == [shown for _, shown in fixed.ITEM_COLUMNS]
    assert dimension.count() == 4


def test_an_unknown_company_keeps_the_good_tables(spark, erp, folder):
    lake = Lake(spark, folder + "/lake")
    run_item_master(lake, erp, 1, TS)
    with pytest.raises(EmptyExtract):
        run_item_master(lake, erp, 99, TS)
    assert lake.read("bronze", BRONZE).count() == 10


def bronze_items(spark, *rows):
    names = [n for n, _ in fixed.ITEM_COLUMNS]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def test_a_price_that_is_no_number_fails(spark):
    with pytest.raises(Exception, match="not a decimal"):
        build_item_silver(bronze_items(spark, {"sku": "a", "sales_price": "x"})).collect()


def test_the_row_with_found_lookups_is_kept(spark):
    silver = build_item_silver(
        bronze_items(
            spark,
            {"sku": "a", "brand_name": None, "upc": "1"},
            {"sku": "a ", "brand_name": " ", "pair_per_unit": "1", "upc": "2"},
            {"sku": " a", "brand_name": "B", "upc": "3"},
            {"sku": "b", "brand_name": "B", "upc": None},
            {"sku": "b", "brand_name": "B", "upc": "009 "},
            {"sku": "   "},
            {"sku": None},
        )
    )
    assert {(r.sku, r.upc) for r in silver.collect()} == {("a", "3"), ("b", "009")}


def test_the_dimension_gate(spark):
    dimension = build_item_dimension(build_item_silver(bronze_items(spark, {"sku": "a"})))
    enforce(grain_gate(dimension, "SKU"), "items")
    with pytest.raises(DataQualityError):
        enforce(grain_gate(dimension.union(dimension), "SKU"), "items")


def test_jdbc_options():
    source = JdbcErp("jdbc:sqlserver://<HOST>", "reader", "secret")
    options = source.options()
    assert options["ApplicationIntent"] == "ReadOnly" and options["queryTimeout"] == "600"
    assert "secret" not in repr(source)
    with pytest.raises(ValueError, match="user"):
        JdbcErp("jdbc:sqlserver://host", "<LOGIN>", "x").options()


def test_every_table_is_read_in_parts_that_cover_it():
    source = JdbcErp("jdbc:sqlserver://host", "reader", "secret", parts=3, splits={"MITSCH": ["a", "b"]})
    assert source.conditions("MITSCH") == ["a", "b"]
    assert source.conditions("MITMAS") == [
        f"ABS(CAST(CHECKSUM(MMITNO) AS BIGINT)) % 3 = {i}" for i in range(3)
    ]


def test_company_filter_is_a_plain_equality(spark, folder):
    spark.range(10).select(F.col("id").cast("int").alias("CONO")).write.parquet(folder + "/t")
    rows = one_company(spark.read.parquet(folder + "/t"), "CONO", 3)
    assert "EqualTo(CONO,3)" in rows._jdf.queryExecution().executedPlan().toString()


def test_command_line(spark, erp, folder):
    settings = {"lake": folder + "/lake", "company": 1, "erp_parquet": erp.root}
    with open(folder + "/settings.json", "w") as stream:
        json.dump(settings, stream)
    assert main(["items", folder + "/settings.json"]) == {BRONZE: 10, SILVER: 4, GOLD: 4}
