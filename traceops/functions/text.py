"""Text made from numbers and file names."""

from pyspark.sql import Column, functions as F

from traceops.functions import as_column, floor_div


def _one_decimal(n: Column, unit: int) -> Column:
    """`n / unit` with one decimal, rounded as C's `%.1f` does it on the double quotient.

    Away from a half that is plain rounding. At a half C rounds what the double holds: less
    than the half goes down, the half itself to an even digit. `error` is the exact difference
    between the double times `unit` and `n`, by splitting the double into two short parts.
    """
    q = n.cast("double") / unit
    wide = q * float(2 ** 27 + 1)
    high = wide - (wide - q)
    error = (high * float(unit) - n) + (q - high) * float(unit)
    at_half = F.pmod(n * 20, F.lit(2 * unit)) == unit
    down = (error < 0) | (F.pmod(n * 4, F.lit(4 * unit)) == unit)
    tenths = floor_div(n * 20 + unit, 2 * unit) - F.when(at_half & down, 1).otherwise(0)
    return F.concat(floor_div(tenths, 10).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"))


def human_count(c) -> Column:
    """1234567 as `1.2M`, 1234 as `1.2k`, 123 as `123`."""
    n = as_column(c).cast("bigint")
    return (F.when(n >= 1_000_000, F.concat(_one_decimal(n, 1_000_000), F.lit("M")))
            .when(n >= 1_000, F.concat(_one_decimal(n, 1_000), F.lit("k")))
            .otherwise(n.cast("string")))


def file_stem(path, length=10) -> Column:
    """First characters of the last part of a path."""
    return F.substring(F.element_at(F.split(as_column(path), "/"), -1), 1, length)


def number_in(name, regex) -> Column:
    """The first group of `regex` in a name as int, null without a match."""
    return F.regexp_extract(as_column(name), regex, 1).try_cast("int")
