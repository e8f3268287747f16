"""Text: trimming, codes, port names, headers, table names and row keys."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fixed


def blank_to_null(text: Column) -> Column:
    """Trimmed text; blanks become NULL.  Only spaces are trimmed, a tab stays."""
    return F.nullif(F.trim(text), F.lit(""))


def code_text(text: Column) -> Column:
    """Trimmed upper-case code; blanks become NULL."""
    return blank_to_null(F.upper(text))


def collapse_spaces(text: Column) -> Column:
    """Every run of white space as one space (the class leaves out vertical tab)."""
    return F.regexp_replace(text, r"[ \t\n\f\r]+", " ")


def port_text(text: Column) -> Column:
    """Port as lower-case text with single spaces; blanks become NULL."""
    return blank_to_null(F.lower(collapse_spaces(text)))


def port_name(text: Column, synonyms: Mapping[str, str] = fixed.PORT_SYNONYMS) -> Column:
    """Upper-case port name of a :func:`port_text`, known misspellings replaced."""
    if not synonyms:
        return F.upper(text)
    pairs = F.create_map(*[F.lit(word) for pair in synonyms.items() for word in pair])
    return F.upper(F.coalesce(F.try_element_at(pairs, text), text))


def clean_header(name: str) -> str:
    """Header as a column name: lower case, runs of other characters as ``_``."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def table_name(text: Column) -> Column:
    """Name as a table name.  Letters of any script are kept, as ``\\w`` means there."""
    return F.btrim(F.regexp_replace(F.lower(text), r"(?U)[^\w]+", "_"), F.lit("_"))


def clean_table_name(name: str) -> str:
    """:func:`table_name` for a name already on the driver."""
    return re.sub(r"[^\w]+", "_", name.lower()).strip("_")


def before_slash(text: Column) -> Column:
    """Text before the first ``/``, or all of it."""
    return F.substring_index(text, "/", 1)


def as_text(column: Column, data_type: T.DataType) -> Column:
    """Value as text, whole floating-point numbers without a fraction.

    A number that arrives as ``123`` in one upload and ``123.0`` in the next must
    give the same business key.
    """
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.cast("string")
    whole = (column == F.floor(column)) & (F.abs(column) < 1e18)
    plain = (F.abs(column) >= 1e-3) & (F.abs(column) < 1e7)
    wide = (F.abs(column) >= 1e-12) & (F.abs(column) < 1e18)
    long_form = F.regexp_replace(column.cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    return (
        F.when(whole, column.cast("bigint").cast("string"))
        .when(plain | ~wide, column.cast("string"))
        .otherwise(long_form)
    )


def key_text(columns: Iterable[Column]) -> Column:
    """The columns in order as one text; NULLs have their own mark."""
    marked = [F.coalesce(c.cast("string"), F.lit(fixed.KEY_NULL)) for c in columns]
    return F.concat_ws(fixed.KEY_SEPARATOR, *marked)


def row_key(columns: Iterable[Column]) -> Column:
    """MD5 over the columns in order."""
    return F.md5(key_text(columns))
