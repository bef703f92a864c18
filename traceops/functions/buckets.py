"""Range buckets."""

from pyspark.sql import Column, functions as F

from traceops.fixed_values import QUARTERS
from traceops.functions import as_column


def quarter(c) -> Column:
    """0..3 for below .25, .5, .75 and the rest."""
    c = as_column(c)
    bucket = F.lit(len(QUARTERS))
    for index in reversed(range(len(QUARTERS))):
        bucket = F.when(c < QUARTERS[index], index).otherwise(bucket)
    return bucket


def range_label(low: float, high: float) -> str:
    return f"{round(low * 100)}-{round(high * 100)}%"
