import hashlib
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import day_text
from tidemark.plans.inputs import _day_form
from tidemark import fixed_values as fixed
from tidemark.functions import dates, numbers, text
from tidemark.plans.leadtime import build_calendar

DAY = date(2024, 1, 5)
PARSED = {
    "2024-01-05": DAY,
    "2024-1-5": DAY,
    "2024/01/05": DAY,
    " 2024-01-05 ": DAY,
    "2024-01-05 00:00:00": DAY,
    "2024-01-05 23:59:59.25": DAY,
    "2024-01-05T10:00:00": DAY,
    "01/05/24": DAY,
    "1/5/24": DAY,
    "01/05/2024": DAY,
    "1/5/2024": DAY,
    "01-05-2024": DAY,
    "1899-12-30": date(1899, 12, 30),
    "02/29/2024": date(2024, 2, 29),
    "01/05/68": date(2068, 1, 5),
    "01/05/69": date(1969, 1, 5),
    "02/29/72": date(1972, 2, 29),
    "TBD": None,
    "": None,
    "   ": None,
    "13/05/24": None,
    "02/30/2024": None,
    "02/29/2023": None,
    "2024": None,
    "2024-01": None,
    "45000": None,
    "45000.0": None,
    "20240105": None,
    "2024-01-05 junk": None,
    "2024-01-05 10:00:61": None,
    "2024-01-05 0:5": DAY,
    "2024-01-05 19:59:59": DAY,
    "2024-01-05 24:00:00": None,
    "2024-01-05 25:10:00": None,
    "2024-01-05 99:59": None,
    "2024/01/05 99:00": None,
    "2024-01-05 10:60": None,
    "2024-01-05T29:00:00": None,
    "2024-01-05T10:00:00Z": None,
    "2024-01/05": None,
    "01-05-24": None,
    None: None,
}


def column(spark, values, type_):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")


def results(df, expression):
    return [row.r for row in df.select("i", expression.alias("r")).orderBy("i").collect()]


def test_date_texts(spark):
    df = column(spark, PARSED, "string")
    found = results(df, dates.parse_date(F.col("v"), T.StringType()))
    assert dict(zip(PARSED, found)) == PARSED


def test_date_by_source_type(spark):
    df = spark.sql("SELECT date'2024-01-05' d, timestamp_ntz'2024-01-05 23:00:00' t, 45000 n")
    row = df.select(*[dates.parse_date(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
    assert row.first() == (DAY, DAY, None)
    assert dict(row.dtypes)["n"] == "date"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(date(1970, 1, 1), date(2060, 12, 31)), min_size=40, max_size=60))
def test_every_form_of_a_date_reads_back(spark, days):
    forms = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%m/%d/%y", "%m/%d/%Y", "%m-%d-%Y"]
    rows = [(d.strftime(f), d) for d in days for f in forms]
    df = spark.createDataFrame(rows, "v string, d date")
    assert df.filter(~dates.parse_date_text(F.col("v")).eqNullSafe(F.col("d"))).count() == 0


def test_guard_keeps_or_drops_but_never_invents(spark):
    rows = [(5.0, DAY, DAY), (5.0, None, DAY), (5.0, DAY, None), (None, DAY, DAY)]
    df = spark.createDataFrame(rows, "x double, a date, b date")
    kept = df.select(dates.between_dates(F.col("x"), F.col("a"), F.col("b")))
    assert [r[0] for r in kept.collect()] == [5.0, None, None, None]


def test_calendar(spark):
    rows = {r.date_key: r for r in build_calendar(spark).collect()}
    assert len(rows) == 4018
    assert min(rows) == fixed.CALENDAR_START and max(rows) == fixed.CALENDAR_END
    for day, row in rows.items():
        assert row.week_number == day.isocalendar().week
        assert row.day_of_week_number == day.isoweekday() % 7
        assert row.is_weekend == (day.isoweekday() > 5)
        assert row.day_name == day.strftime("%A")
        assert row.month_name == day.strftime("%B")
        assert row.month_short_name == day.strftime("%b")
        assert row.year_month == day.strftime("%Y-%m")
        assert row.quarter == f"Q{(day.month + 2) // 3}" and row.quarter_number == (day.month + 2) // 3
        assert (row.year, row.month_number, row.day) == (day.year, day.month, day.day)
    types = dict(build_calendar(spark).dtypes)
    assert types["date_key"] == "date" and types["is_weekend"] == "boolean"
    assert {types[c] for c in ("year", "week_number", "day_of_week_number")} == {"int"}
    assert rows[date(2021, 1, 3)].week_number == 53


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        ("ho  chi\tminh", "HO CHI MINH"),
        ("Hochiminh", "HO CHI MINH"),
        (" SEKOU ", "SHEKOU"),
        ("XianGang", "XINGANG"),
        ("Nhava  Sheva,\nIN", "NHAVA SHEVA"),
        ("Rotterdam", "ROTTERDAM"),
        (" \t ", None),
        ("", None),
        (None, None),
        ("a\x0bb", "A\x0bB"),
    ],
)
def test_port(spark, raw, name):
    df = column(spark, [raw], "string")
    assert results(df, text.port_name(text.port_text(F.col("v")))) == [name]


def test_every_synonym(spark):
    df = column(spark, [f" {w.upper()} " for w in fixed.PORT_SYNONYMS], "string")
    found = results(df, text.port_name(text.port_text(F.col("v"))))
    assert found == [name.upper() for name in fixed.PORT_SYNONYMS.values()]


def test_codes_and_blanks(spark):
    df = column(spark, [" e1 ", "   ", "", None, "\tx"], "string")
    assert results(df, text.code_text(F.col("v"))) == ["E1", None, None, None, "\tX"]
    assert results(df, text.blank_to_null(F.col("v"))) == ["e1", None, None, None, "\tx"]


def test_headers():
    assert text.clean_header(" ASN # ") == "asn"
    assert text.clean_header("B/L") == "b_l"
    assert text.clean_header("POS-Consolidation to Gate In") == "pos_consolidation_to_gate_in"
    assert text.clean_header("Min of PO Head Req. Delivery Date") == "min_of_po_head_req_delivery_date"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB9_ .-#/()éÜ日\t"), max_size=12), min_size=30, max_size=40))
def test_table_name_on_rows_and_on_driver_agree(spark, names):
    df = column(spark, names, "string")
    assert results(df, text.table_name(F.col("v"))) == [text.clean_table_name(n) for n in names]


def test_before_slash(spark):
    df = column(spark, ["ABC/red", "/red", "ABC", "a/b/c", None], "string")
    assert results(df, text.before_slash(F.col("v"))) == ["ABC", "", "ABC", "a", None]


def test_numbers_as_text(spark):
    values = [123.0, 1e7, 12345678.9, 0.5, -2.0, 123456789012.25, None]
    df = column(spark, values, "double")
    wanted = ["123", "10000000", "12345678.9", "0.5", "-2", "123456789012.25", None]
    assert results(df, text.as_text(F.col("v"), T.DoubleType())) == wanted


def test_strict_decimal(spark):
    df = column(spark, [" 12.345 ", "1e2", "-2.345", "", "  ", None], "string")
    found = results(df, numbers.strict_decimal(F.col("v"), "decimal(17,2)"))
    assert found == [Decimal("12.35"), Decimal("100.00"), Decimal("-2.35"), None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_decimal_fails_on_text(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = column(spark, ["1", "x"], "string")
        with pytest.raises(Exception, match="not a decimal"):
            results(df, numbers.strict_decimal(F.col("v"), "decimal(17,2)"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_price_rounds_half_away_from_zero(spark):
    df = column(spark, [Decimal("0.125"), Decimal("-0.125"), Decimal("2.344")], "decimal(18,3)")
    assert results(df, numbers.price(F.col("v"))) == [
        Decimal("0.13"), Decimal("-0.13"), Decimal("2.34"),
    ]


def test_row_key(spark):
    df = spark.createDataFrame([(DAY, "A", None), (None, None, None)], "d date, a string, b string")
    keys = [r[0] for r in df.select(text.row_key(F.col(c) for c in df.columns)).collect()]
    plain = ["2024-01-05|A|<NULL>", "<NULL>|<NULL>|<NULL>"]
    assert keys == [hashlib.md5(p.encode()).hexdigest() for p in plain]


def test_days_between_is_inclusive(spark):
    bounds = spark.range(1)
    days = dates.days_between(bounds, F.lit(DAY), F.lit(DAY + timedelta(days=2)))
    assert [r[0] for r in days.collect()] == [DAY + timedelta(days=i) for i in range(3)]


def test_days_as_text_are_what_a_cast_and_a_format_give(spark):
    days = ["0001-01-01", "0999-12-31", "1000-01-01", "1995-02-03", "9999-12-31", "+10000-01-01", None]
    rows = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    forms = ["M/d/yyyy", "MM-dd-yyyy", "yyyy-MM-dd"]
    got = rows.select(
        day_text(F.col("d")).eqNullSafe(F.col("d").cast("string")).alias("text"),
        *[_day_form(F.col("d"), f).eqNullSafe(F.date_format("d", f)).alias(f) for f in forms],
    )
    assert all(all(row) for row in got.collect())
