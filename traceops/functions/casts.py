"""Casts and predicates that turn bad input into null instead of an error."""

from pyspark.sql import Column, functions as F

from traceops.functions import as_column


def number(c) -> Column:
    """Text as double, null when it is none."""
    return as_column(c).try_cast("double")


def number_or_zero(c) -> Column:
    return F.coalesce(number(c), F.lit(0.0))


def whole(c) -> Column:
    """Number text cut to a long, so `1.5e9` is accepted; null when it is none or too big."""
    return number(c).try_cast("bigint")


def filled(c) -> Column:
    """True for text with something other than spaces, false for blank, null for null."""
    return F.trim(as_column(c).cast("string")) != ""


def flag(condition) -> Column:
    return F.when(condition, 1).otherwise(0)


def share(part, total, scale=1.0) -> Column:
    """`scale * part / total`, 0 when the total is 0 or null."""
    return F.coalesce(F.try_divide(as_column(part) * F.lit(scale), as_column(total)), F.lit(0.0))
