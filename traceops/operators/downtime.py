"""Capacity lost while a machine is away between its removal and its return."""

from pyspark.sql import DataFrame, functions as F

from traceops.fixed_values import MACHINE_ADD, MACHINE_REMOVE
from traceops.functions.casts import share
from traceops.operators.neighbours import SLICE_ROWS, followed_by


def downtime_periods(df: DataFrame, entity: str, ts: str, event: str, capacity: str,
                     down=MACHINE_REMOVE, up=MACHINE_ADD, tiebreak: list[str] = (),
                     slice_rows=SLICE_ROWS) -> DataFrame:
    """`(entity, start, end, offline_time, lost_power)` for each `down` directly followed by `up`.

    "Directly" is by `ts`, then `tiebreak`. The capacity is that of the `down` row, 0 if null.
    """
    rows = df.select(entity, ts, *tiebreak, event, F.coalesce(capacity, F.lit(0.0)).alias("_capacity"))
    pairs = followed_by(rows, entity, [ts, *tiebreak], F.col(event) == down, F.col(event) == up,
                        ["_capacity"], slice_rows)
    offline = f"`{ts}` - before.`{ts}`"
    return pairs.selectExpr(f"`{entity}`", f"before.`{ts}` AS start", f"`{ts}` AS end",
                            f"{offline} AS offline_time", f"({offline}) * before._capacity AS lost_power")


def downtime_loss(df: DataFrame, entity: str, ts: str, event: str, capacity: str,
                  down=MACHINE_REMOVE, up=MACHINE_ADD, tiebreak: list[str] = (),
                  slice_rows=SLICE_ROWS) -> DataFrame:
    """One row: power lost in all gaps, power available, lost share in percent.

    Available is the time between the first and last row of the table times the capacity of
    all `up` rows, repeated ones included. Empty input gives zeros.
    """
    periods = downtime_periods(df, entity, ts, event, capacity, down, up, tiebreak, slice_rows)
    lost = periods.agg(F.coalesce(F.sum("lost_power"), F.lit(0.0))).scalar()
    added = F.sum(F.when(F.col(event) == up, F.coalesce(capacity, F.lit(0.0))))
    available = F.coalesce((F.max(ts) - F.min(ts)) * added, F.lit(0.0))
    return (df.agg(available.alias("total_available_power"))
            .select(lost.alias("total_lost_power"), "total_available_power")
            .withColumn("percentage_lost", share("total_lost_power", "total_available_power", 100.0)))
