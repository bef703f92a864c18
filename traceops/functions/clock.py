"""Times: epoch numbers, hours of the day, `HH:MM:SS` and `m:ss` text."""

from pyspark.sql import Column, functions as F

from traceops.functions import as_column, floor_div

UNITS = {"s": 1, "ms": 1_000, "us": 1_000_000}

# seconds a Spark timestamp can hold in either direction
_LAST_SECOND = 9_223_372_036_854


def hour_of_day(ts, unit="s") -> Column:
    """Hour 0..23 of an epoch number. `unit="s"` reads the number as seconds, as it stands."""
    second = UNITS[unit]
    return floor_div(F.pmod(as_column(ts), F.lit(86_400 * second)), 3_600 * second).cast("int")


def event_time(ts, unit="s") -> Column:
    """Epoch number as a timestamp; null beyond the range of timestamps."""
    ts = as_column(ts)
    if unit == "us":
        return F.timestamp_micros(ts)
    convert = F.timestamp_millis if unit == "ms" else F.timestamp_seconds
    limit = _LAST_SECOND * UNITS[unit]
    return F.when(ts.between(-limit, limit), convert(ts))


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def hms(c) -> Column:
    """Seconds as `HH:MM:SS` within a day, fractions cut."""
    t = F.pmod(F.floor(as_column(c)), F.lit(86_400))
    return F.concat(_two(floor_div(t, 3600)), F.lit(":"), _two(F.pmod(floor_div(t, 60), F.lit(60))),
                    F.lit(":"), _two(F.pmod(t, F.lit(60))))


def hms_seconds(c) -> Column:
    """`HH:MM:SS` as seconds, null for other text."""
    parts = F.split(as_column(c), ":")
    hours, minutes, secs = (F.get(parts, F.lit(i)).try_cast("bigint") for i in range(3))
    return hours * 3600 + minutes * 60 + secs


def minutes_label(c) -> Column:
    """Seconds as `m:ss`."""
    t = F.floor(as_column(c))
    return F.concat(floor_div(t, 60).cast("string"), F.lit(":"), _two(F.pmod(t, F.lit(60))))
