"""Dates as text by look-up: the same as Spark's formatter, each part taken once."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import day_text
from tidemark.plans.inputs import _day_form, _leg_columns

EDGES = [
    date(1, 1, 1), date(999, 12, 31), date(1582, 10, 15), date(1899, 12, 31), date(1900, 1, 1), date(1996, 2, 29),
    date(2000, 10, 9), date(2100, 12, 31), date(2101, 1, 1), date(9999, 12, 31), None,
]


@pytest.fixture
def days(spark):
    # Not a local relation, which the optimizer would work out by itself.
    return spark.createDataFrame([(d,) for d in EDGES], "d date").repartition(2)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_look_ups_give_what_the_formatter_gives(days):
    forms = ["M/d/yyyy", "MM-dd-yyyy", "yyyy-MM-dd"]
    same = days.select(
        day_text(F.col("d")).eqNullSafe(F.col("d").cast("string")),
        *[_day_form(F.col("d"), form).eqNullSafe(F.date_format("d", form)) for form in forms],
    ).collect()
    assert len(same) == len(EDGES) and all(all(row) for row in same)


def test_each_part_of_a_day_is_taken_once(days):
    for text in (day_text(F.col("d")), _day_form(F.col("d"), "M/d/yyyy"), _day_form(F.col("d"), "MM-dd-yyyy")):
        plan = optimized(days.select(text.alias("t")))
        for part in ("year", "month", "dayofmonth"):
            assert len(re.findall(rf"\b{part}\(", plan)) == 1, plan
        assert "split(" not in plan  # one literal, not taken apart per row


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def test_the_month_of_a_leg_keeps_out_of_time_zones(spark, zone):
    moments = [
        datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1996, 2, 29, 12), datetime(2018, 11, 4, 0, 30),
        datetime(2001, 11, 1), datetime(1899, 5, 31, 23), None,
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(m,) for m in moments], "l_shipdate timestamp_ntz").repartition(2)
        etd = rows.select("l_shipdate", _leg_columns()["etd"].alias("etd"))
        assert "date_trunc" not in optimized(etd)
        for row in etd.collect():
            m = row.l_shipdate
            assert row.etd == (m and datetime(m.year, m.month, 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
