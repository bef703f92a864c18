"""Column helpers: every function takes column names or Columns and returns a Column."""

from pyspark.sql import Column, functions as F


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(a, b: int) -> Column:
    """Whole-number division of a long, rounded down, without a detour over doubles."""
    a, b = as_column(a), F.lit(b)
    return F.call_function("div", a - F.pmod(a, b), b)
