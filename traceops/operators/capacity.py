"""Histogram of a value over given ranges."""

from pyspark.sql import DataFrame

from traceops.fixed_values import CAPACITY_RANGES
from traceops.functions import as_column
from traceops.functions.buckets import range_label


def capacity_distribution(df: DataFrame, value, ranges=None, mode="half_open") -> DataFrame:
    """Rows per range as `(range, count)`, in one pass and without a join.

    `half_open` counts `low < x <= high`, so values outside every range count nowhere, and
    keeps empty ranges with 0. `total` has no lower bound on the first range and no upper
    one on the last, so each non-null value counts once, and leaves empty ranges out.
    """
    if mode not in ("half_open", "total"):
        raise ValueError(f"mode is half_open or total, not {mode}")
    ranges = ranges or CAPACITY_RANGES
    last = len(ranges) - 1

    def inside(i):
        low, high = ranges[i]
        above = "true" if mode == "total" and i == 0 else f"x > {low!r}D"
        below = "x IS NOT NULL" if mode == "total" and i == last else f"x <= {high!r}D"
        return f"count_if({above} AND {below}) AS r{i}"

    rows = ", ".join(f"struct('{range_label(*r)}' AS range, r{i} AS count)" for i, r in enumerate(ranges))
    result = (df.select(as_column(value).alias("x"))
              .selectExpr(*(inside(i) for i in range(len(ranges)))).selectExpr(f"inline(array({rows}))"))
    return result.filter("count > 0") if mode == "total" else result
