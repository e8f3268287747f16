"""Item master: ERP tables to one typed row per SKU to a dimension."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.numbers import price, strict_decimal
from tidemark.functions.text import before_slash, blank_to_null
from tidemark.operators import publish, quality
from tidemark.operators.dedup import keep_first
from tidemark.operators.joins import BROADCAST_BYTES, Lookup, left_lookups
from tidemark.operators.landing import LINEAGE, land_text, quoted, stamp
from tidemark.operators.reshape import clustered
from tidemark.session import size_shuffles
from tidemark.sources.erp import JdbcErp, ParquetErp, read_erp
from tidemark.sources.lake import Lake

BRONZE = "erp_item_master"
SILVER = "item_master"
GOLD = "dim_item"


def _key(column: str) -> Column:
    """ERP string keys are padded; trailing blanks do not count in a comparison."""
    return F.rtrim(F.col(column))


def _is(column: str, value: str) -> Column:
    return _key(column) == F.lit(value)


def item_size(unit: str, package: str, matrix_size: str) -> Column:
    """Package code for case items, else the style matrix size."""
    return F.rtrim(F.when(_is(unit, fixed.CASE_UNIT), F.col(package)).otherwise(F.col(matrix_size)))


def pairs_per_unit(unit: str, factor: str) -> Column:
    """Conversion factor for case items (NULL if there is none), else one."""
    number = "decimal(18,4)"
    one = F.lit(1).cast(number)
    return F.when(_is(unit, fixed.CASE_UNIT), F.col(factor).cast(number)).otherwise(one)


def item_lookups(tables: Mapping[str, DataFrame]) -> list[Lookup]:
    """The six lookups, reduced to the rows and columns the item query uses."""
    units = tables["MITAUN"].filter(
        (F.col("MUAUS9") == fixed.UNIT_FLAG) & (F.col("MUAUTP") == fixed.UNIT_TYPE)
    )
    aliases = tables["MITPOP"].filter(
        (F.col("MPALWT") == fixed.ALIAS_TYPE) & _is("MPALWQ", fixed.ALIAS_QUALIFIER)
    )
    brands = tables["CSYTAB"].filter(_is("CTSTCO", fixed.BRAND_TABLE))

    def groups(level: int, name: str) -> DataFrame:
        return tables["MITSCH"].filter(F.col("SGGLVL") == level).select(
            F.col("SGCONO").alias(f"{name}_company"),
            _key("SGSGP0").alias(f"{name}_group"),
            F.col("SGTX40").alias(name),
        )

    return [
        Lookup(
            units.select("MUCONO", _key("MUITNO").alias("MUITNO"), "MUCOFA"),
            (("MMCONO", "MUCONO"), ("item_key", "MUITNO")),
        ),
        Lookup(
            tables["MITMAH"].select(
                "HMCONO", _key("HMITNO").alias("HMITNO"), "HMSTYN", "HMOPTX", "HMOPTY"
            ),
            (("MMCONO", "HMCONO"), ("item_key", "HMITNO")),
        ),
        Lookup(
            aliases.select("MPCONO", _key("MPITNO").alias("MPITNO"), "MPPOPN"),
            (("MMCONO", "MPCONO"), ("alias_key", "MPITNO")),
        ),
        Lookup(
            brands.select("CTCONO", _key("CTSTKY").alias("CTSTKY"), "CTTX15"),
            (("MMCONO", "CTCONO"), ("brand_key", "CTSTKY")),
        ),
        Lookup(
            groups(fixed.CATEGORY_LEVEL, "category"),
            (("MMCONO", "category_company"), ("category_key", "category_group")),
        ),
        Lookup(
            groups(fixed.SUB_CATEGORY_LEVEL, "sub_category"),
            (("MMCONO", "sub_category_company"), ("sub_category_key", "sub_category_group")),
        ),
    ]


def enrich_items(
    tables: Mapping[str, DataFrame], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Items with their lookups, under Silver column names; lookups may fan items out."""
    items = tables["MITMAS"].select(
        *fixed.ERP_COLUMNS["MITMAS"],
        _key("MMITNO").alias("item_key"),
        _key("MMITNE").alias("alias_key"),
        _key("MMITCL").alias("brand_key"),
        _key("MMGRP1").alias("category_key"),
        _key("MMGRP3").alias("sub_category_key"),
    )
    joined = left_lookups(items, item_lookups(tables), broadcast_bytes)
    columns = {
        "sku": F.trim("MMITNO"),
        "brand_name": F.trim("CTTX15"),
        "brand": F.col("MMITCL"),
        "style_name": before_slash(F.col("MMITDS")),
        "style": F.trim("HMSTYN"),
        "color_name": F.col("MMSPE4"),
        "year_season": F.trim("MMCFI1"),
        "size": item_size("MMUNMS", "MMSPAC", "HMOPTX"),
        "width": F.trim("HMOPTY"),
        "category": F.rtrim("category"),
        "sub_category": F.rtrim("sub_category"),
        "pair_per_unit": pairs_per_unit("MMUNMS", "MUCOFA"),
        "package": F.col("MMSPAC"),
        "upc": F.col("MPPOPN"),
        "sales_price": price(F.col("MMSAPR")),
        "purchase_price": price(F.col("MMPUPR")),
        "unit_of_measure": F.col("MMUNMS"),
    }
    return joined.select(*[columns[name].alias(name) for name, _ in fixed.ITEM_COLUMNS])


def type_items(bronze: DataFrame) -> DataFrame:
    """Trimmed texts and strict decimals; a value that is not a number fails the run."""
    columns = [
        strict_decimal(F.col(name), fixed.ITEM_NUMBERS[name]).alias(name)
        if name in fixed.ITEM_NUMBERS
        else blank_to_null(F.col(name)).alias(name)
        for name, _ in fixed.ITEM_COLUMNS
    ]
    return bronze.select(*columns, *[c for c in LINEAGE if c in bronze.columns])


def one_per_sku(items: DataFrame) -> DataFrame:
    """One row per SKU, rows whose lookups found something first."""
    known = items.filter(F.col("sku").isNotNull())
    return keep_first(known, ["sku"], dict.fromkeys(fixed.ITEM_PREFERENCE, "asc"))


def build_item_silver(bronze: DataFrame) -> DataFrame:
    return one_per_sku(type_items(bronze))


def build_item_dimension(silver: DataFrame) -> DataFrame:
    """The item dimension under display names."""
    return silver.select(*[quoted(name).alias(shown) for name, shown in fixed.ITEM_COLUMNS])


def item_report(bronze: DataFrame) -> DataFrame:
    return quality.load_report(bronze, "sku")


def erp_table(name: str) -> str:
    return f"erp_{name.lower()}"


def land_erp(lake: Lake, source: ParquetErp | JdbcErp, company: int) -> dict[str, DataFrame]:
    """Every base table copied to Bronze once, and read from there."""
    tables = read_erp(lake.spark, source, company)
    for name, rows in tables.items():
        lake.write("bronze", erp_table(name), rows)
    return {name: lake.read("bronze", erp_table(name)) for name in tables}


def item_reports(lake: Lake) -> dict[str, DataFrame]:
    """What to look at after a run: rows that landed, and rows the one-per-SKU step dropped."""
    bronze = lake.read("bronze", BRONZE)
    return {"items": item_report(bronze), "repeated": quality.repeat_report(bronze, "sku")}


def run_item_master(
    lake: Lake,
    source: ParquetErp | JdbcErp,
    company: int,
    run_ts: datetime,
    export_folders: Iterable[str] = (),
) -> dict[str, int]:
    """The whole subject: base tables landed once, joined to Bronze as text, Silver, the gated
    dimension, copies."""
    spark = lake.spark
    lake.create_layers()
    landed = land_erp(lake, source, company)
    size_shuffles(spark, [lake.path("bronze", erp_table(name)) for name in landed])
    extract = land_text(enrich_items(landed))
    bronze_rows = lake.write("bronze", BRONZE, stamp(extract, run_ts, BRONZE), allow_empty=False)

    silver = clustered(build_item_silver(lake.read("bronze", BRONZE)), "sku")
    silver_rows = lake.write("silver", SILVER, silver)

    dimension = clustered(build_item_dimension(lake.read("silver", SILVER)), "SKU")
    gold_rows = lake.write(
        "gold", GOLD, dimension,
        check=lambda table: quality.enforce(quality.grain_gate(table, "SKU"), "item dimension"),
    )
    publish.copy_to_folders(spark, lake.path("gold", GOLD), export_folders)
    return {BRONZE: bronze_rows, SILVER: silver_rows, GOLD: gold_rows}
