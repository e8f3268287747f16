"""Reports on the keys of Silver, without ranking whole legs."""

import re
from datetime import datetime

import pytest
from legs import bronze_row, bronze_table
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.dedup import first_values, keep_first
from tidemark.operators.drift import SourceSpec, align_all
from tidemark.plans.leadtime import LEG_TABLE, NULL_COLUMNS, PERIOD, build_silver, silver_keys
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def items(spark, tmp_path_factory):
    """Line items of seven years, each leg in one period."""
    path = str(tmp_path_factory.mktemp("items"))
    n = F.col("id")
    spark.range(700).select(
        n.alias("l_orderkey"), n.alias("l_partkey"), (n % 9).alias("l_suppkey"),
        (n % 7 + 1).cast("int").alias("l_linenumber"), (n % 5).cast("double").alias("l_quantity"),
        F.lit(9.5).alias("l_extendedprice"), F.lit(0.02).alias("l_discount"), F.lit(0.01).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (n % 3 + 1).cast("int")).alias("l_returnflag"),
        F.when(n % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.date_add(F.lit("1995-01-02").cast("date"), (n * 3).cast("int")).cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


def final_plan(df):
    """The plan that ran, once adaptive execution has had its say."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "== Final Plan ==" in plan
    return plan.split("== Initial Plan ==")[0]


def test_period_report_ranks_no_leg_where_periods_agree(spark, items):
    plan = final_plan(QUERIES["report_period"](spark, items))
    # Each of the seven sources is read once, without the columns that only a ranking reads.
    scans = re.findall(r"FileScan parquet \[([^]]*)", plan)
    assert len(scans) == 7 and not any("l_extendedprice" in columns for columns in scans)


@pytest.mark.parametrize("name", ["report_duplicates", "null_gate"])
def test_reports_on_keys_rank_nothing(spark, items, name):
    plan = QUERIES[name](spark, items)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and "row_number" not in plan
    assert not any("l_extendedprice" in columns for columns in re.findall(r"FileScan parquet \[([^]]*)", plan))


def test_first_values_are_those_of_the_rows_kept(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 7 != 0, (F.col("id") % 900).cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 3 == 1, -0.0).alias("x"),
        (F.xxhash64("id") % 5).alias("v"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 11).alias("t"),
    )
    order, keys = {"v": "desc"}, ["k", "x"]
    values = {"n": F.coalesce("t", F.lit(-1)), "known": F.col("t").isNotNull().cast("int")}
    wanted = keep_first(rows, keys, order).select(*keys, *[v.alias(n) for n, v in values.items()])
    found = first_values(rows, keys, order, values)
    assert found.columns == wanted.columns
    assert found.count() == wanted.count() > 900
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    alone = first_values(rows, keys, order, {})
    assert alone.exceptAll(wanted.select(*keys)).isEmpty() and alone.count() == wanted.count()
    # All rows have one value: nothing is ranked.
    assert "EmptyRelation" in final_plan(first_values(rows, keys, order, {"one": F.lit(1)}))


def legs_in_two_periods(spark):
    early, late = datetime(2025, 8, 1, 9), datetime(2025, 8, 2, 9)
    first = [
        bronze_row(asn="both", _bronze_insert_ts=early, p_u=None),
        bronze_row(asn="same", _bronze_insert_ts=late),
        bronze_row(asn="tie", vessel="b", asn_receive=None),
        bronze_row(asn="first"),
        bronze_row(asn="null", etd=None, _bronze_insert_ts=None),
        bronze_row(asn="case", wh="e1"),
    ]
    second = [
        bronze_row(asn="both", _bronze_insert_ts=late, current_eta_port=None),
        bronze_row(asn="same", _bronze_insert_ts=early),
        bronze_row(asn="tie", vessel="a"),
        bronze_row(asn="null", etd=None, _bronze_insert_ts=late),
        bronze_row(asn="case", wh="E1 "),
        bronze_row(asn="case", wh="E1 ", vessel="twice"),
    ]
    tables = {"one": bronze_table(spark, first), "two": bronze_table(spark, second)}
    return tables, [SourceSpec("2025_Q3", "one"), SourceSpec("2025_Q4", "two")]


def test_reports_on_keys_are_those_on_silver(spark):
    tables, sources = legs_in_two_periods(spark)
    silver = build_silver(tables, sources)
    legs = align_all(tables, LEG_TABLE, sources)
    keys = silver_keys(legs, sources, ["current_eta_port", "p_u", "asn_receive"])
    assert {(r.asn, r[PERIOD]) for r in silver.collect()} == {(r.asn, r[PERIOD]) for r in keys.collect()}
    assert keys.filter("asn = 'both'").first()[PERIOD] == "2025_Q4"
    for report in (
        lambda df: quality.period_report(df, PERIOD, "etd"),
        lambda df: quality.total_report(df, PERIOD, "etd"),
        lambda df: quality.null_report(df, PERIOD, NULL_COLUMNS),
        lambda df: quality.null_gate(df, "etd"),
        quality.duplicate_report,
    ):
        assert report(keys).collect() == report(silver).collect()
    assert quality.duplicate_report(silver_keys(legs)).collect() == quality.duplicate_report(silver).collect()
