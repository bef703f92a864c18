"""Counts and rates per class."""

from pyspark.sql import Column, DataFrame, functions as F

from traceops.functions.casts import flag


def _classed(df: DataFrame, cls: str) -> DataFrame:
    return df.filter(F.col(cls).isNotNull())


def distinct_per_class(df: DataFrame, cls: str, keys) -> DataFrame:
    """Distinct keys per class as `(cls, count)`. Several keys count as one composite key.

    Spark removes duplicates of (class, key) before the shuffle and spreads a class over
    its keys, so a class with most of the rows is no hot spot.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    # a null part drops the row, as count(distinct a, b) does
    return (_classed(df, cls).groupBy(cls)
            .agg(F.count_distinct(*(F.col(k) for k in keys)).alias("count")).orderBy(cls))


def rows_per_class(df: DataFrame, cls: str) -> DataFrame:
    return _classed(df, cls).groupBy(cls).agg(F.count("*").alias("count")).orderBy(cls)


def event_rate_by_class(df: DataFrame, cls: str, is_hit: Column, digits=4) -> DataFrame:
    """Events, hits and hits per event of each class."""
    return (_classed(df, cls).groupBy(cls)
            .agg(F.count("*").alias("total"), F.sum(flag(is_hit)).alias("hits"))
            .withColumn("probability", F.round(F.col("hits") / F.col("total"), digits))
            .orderBy(cls))
