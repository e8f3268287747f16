"""Dates: a tolerant parser, a guard for durations, and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hours 0 to 23: the end of a day written as 24:00 is no time.
TIME = r"(?:[ T](?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d+)?)?)?"

# The usual form: year first with dashes.  Only the date part is captured.
DASHED = rf"^\s*(\d{{4}}-\d{{1,2}}-\d{{1,2}}){TIME}\s*$"

# All other forms, and the dashed date each stands for.  A two-digit year below 69 is in
# this century.
OTHER_FORMS = [
    (rf"^\s*(\d{{4}})([/ ])(\d{{1,2}})\2(\d{{1,2}}){TIME}\s*$", "$1-$3-$4"),
    (r"^\s*(\d{1,2})([-/])(\d{1,2})\2(\d{4})\s*$", "$4-$1-$3"),
    (r"^\s*(\d{1,2})/(\d{1,2})/([0-5]\d|6[0-8])\s*$", "20$3-$1-$2"),
    (r"^\s*(\d{1,2})/(\d{1,2})/(69|[7-9]\d)\s*$", "19$3-$1-$2"),
]


def parse_date_text(text: Column) -> Column:
    """Date of a text in any accepted form, NULL for everything else.

    Each pattern is anchored, so a bare year, a serial number or trailing junk is
    not a date.  The usual form costs one match and Spark's own date cast.
    """
    other = F.lit(None).cast("string")
    for pattern, dashed in reversed(OTHER_FORMS):
        rewritten = F.regexp_replace(text, pattern, dashed)
        other = F.when(text.rlike(pattern), rewritten).otherwise(other)
    return F.coalesce(
        F.regexp_extract(text, DASHED, 1).try_cast("date"), other.try_cast("date")
    )


def parse_date(column: Column, data_type: T.DataType) -> Column:
    """Date of a source column, chosen by its type; a number is never a date."""
    if isinstance(data_type, T.DateType):
        return column
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("date")
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return parse_date_text(column)
    return F.lit(None).cast("date")


def between_dates(value: Column, start: Column, end: Column) -> Column:
    """A source duration, kept only when both dates it spans are known."""
    return F.when(start.isNotNull() & end.isNotNull(), value)


# Parts of a date as text, by number: a look-up costs less than making the text.
YEARS, MONTHS, DAYS = (1900, 2100), (1, 12), (1, 31)


def part_text(number: Column, span: tuple[int, int], form: str) -> Column:
    """The text of a number, NULL outside ``span``."""
    texts = ",".join(form % n for n in range(span[0], span[1] + 1))
    # One literal once the optimizer has folded it.
    return F.get(F.split(F.lit(texts), ","), number - span[0])


def day_text(day: Column) -> Column:
    """A date as text, as a cast gives it; years in YEARS without the slower formatter."""
    parts = [
        part_text(F.year(day), YEARS, "%d"), part_text(F.month(day), MONTHS, "-%02d"),
        part_text(F.dayofmonth(day), DAYS, "-%02d"),
    ]
    return F.coalesce(F.concat(*parts), day.cast("string"))


def days_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day for each row of bounds, both ends included."""
    days = F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date_key"))


def calendar_columns(day: Column) -> list[Column]:
    """Attributes of a day: parts, names, ISO week, weekend flag."""
    weekday = F.dayofweek(day) - 1  # 0 is Sunday
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short_name"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week_number"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_number"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        weekday.isin(0, 6).alias("is_weekend"),
    ]
