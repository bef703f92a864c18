"""Means per hour of the day."""

from pyspark.sql import DataFrame, functions as F

from traceops.functions.clock import hour_of_day


def hourly_profile(df: DataFrame, ts, cols: dict[str, str], unit="s") -> DataFrame:
    """`(hour, <mean>...)`; `cols` maps result names to value columns.

    A row counts when its time and all its values are there. Trace times are microseconds:
    `unit="us"` gives real hours, `unit="s"` takes them for seconds.
    """
    rows = df.select(hour_of_day(ts, unit).alias("hour"), *cols.values()).dropna()
    return (rows.groupBy("hour")
            .agg(*(F.avg(c).alias(name) for name, c in cols.items())).orderBy("hour"))


def hourly_profiles(df: DataFrame, ts, cols: dict[str, str], units=("s", "us"), keep=lambda sums: sums) -> dict[str, DataFrame]:
    """`hourly_profile` for several readings of the time from one pass over the rows.

    Sums are taken by the hours of all readings together, 24 for each at most, and added up for each. `keep` may persist them.
    """
    hours = {unit: f"_hour_{unit}" for unit in units}
    rows = df.select(*(hour_of_day(ts, unit).alias(name) for unit, name in hours.items()), *cols.values()).dropna()
    sums = keep(rows.groupBy(*hours.values()).agg(F.count("*").alias("_rows"), *(F.sum(c).alias(f"_sum_{name}") for name, c in cols.items())))
    return {unit: sums.groupBy(F.col(hour).alias("hour")).agg(
        *((F.sum(f"_sum_{name}") / F.sum("_rows")).alias(name) for name in cols)).orderBy("hour") for unit, hour in hours.items()}
