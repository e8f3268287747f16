"""Numbers that must be exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import blank_to_null


def strict_decimal(text: Column, decimal_type: str) -> Column:
    """Number in a padded text; blank is NULL and anything else fails the query.

    The failure is raised explicitly, so it does not depend on ANSI mode.
    """
    value = blank_to_null(text)
    message = F.concat(F.lit("not a " + decimal_type + ": "), value)
    failure = F.when(value.isNotNull(), F.raise_error(message).cast(decimal_type))
    return F.coalesce(value.try_cast(decimal_type), failure)


def price(amount: Column) -> Column:
    """Amount rounded half away from zero to two decimals; the input is a decimal."""
    return F.round(amount, 2).cast("decimal(17,2)")
