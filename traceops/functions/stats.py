"""Correlation as an aggregate column."""

from pyspark.sql import Column, functions as F

from traceops.functions import as_column


def pearson(x, y) -> Column:
    """Pearson correlation; null when a side is constant or there is no row.

    The built-in `corr` raises a division error there in ANSI mode. Rows with a null on
    either side count on neither.
    """
    x, y = as_column(x).cast("double"), as_column(y).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
