"""Numbers in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repoquarry.functions.text import strip

def number(c: Column) -> Column:
    """Exact value of a numeric text; anything else, NaN, infinities and '12d' give null.

    The decimal parser knows none of the latter, so one cast does without a pattern match.
    """
    return strip(c.cast("string")).try_cast("decimal(38,18)")


def whole(c: Column) -> Column:
    """Numeric text cut to a whole number."""
    return number(c).try_cast("bigint")


def whole_not_negative(c: Column) -> Column:
    value = number(c)
    return F.when(value >= 0, value.try_cast("bigint"))


def digits_only(c: Column) -> Column:
    """Value of an unsigned integer text, null otherwise (a binary file's '-')."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def ratio(part: Column, total: Column) -> Column:
    """part / total, 0 where there is nothing to divide by."""
    return F.when(total > 0, part.cast("double") / total).otherwise(F.lit(0.0))
