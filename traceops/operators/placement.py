"""Jobs on one machine against jobs on several."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from traceops.fixed_values import PLACEMENT_LABELS
from traceops.functions.casts import filled, share


def _placed(df: DataFrame, job: str, machine: str, drop_unplaced: bool) -> DataFrame:
    rows = df.select(F.col(job), F.col(machine))
    text = dict(rows.dtypes)[machine] == "string"
    if drop_unplaced:
        return rows.filter(filled(machine) if text else F.col(machine).isNotNull())
    return rows.withColumn(machine, F.when(filled(machine), F.col(machine)).otherwise("")) if text else rows


def machines_per_job(df: DataFrame, job: str, machine: str, drop_unplaced=True) -> DataFrame:
    """Distinct machines of each job as `(job, machine_count)`."""
    rows = _placed(df, job, machine, drop_unplaced)
    machines = F.count_distinct(machine)
    if not drop_unplaced and dict(rows.dtypes)[machine] != "string":
        # count distinct passes over the null that stands for a blank
        machines = machines + F.max(F.col(machine).isNull().cast("bigint"))
    return rows.groupBy(job).agg(machines.alias("machine_count"))


def placement_spread(df: DataFrame, job: str, machine: str, drop_unplaced=True) -> DataFrame:
    """`(category, count, percentage)`: jobs seen on one machine and on several.

    A job is on one machine when its smallest and largest machine are the same, so nothing
    has to be counted as distinct: one aggregate, combined before its only shuffle. Text is
    compared by two hashes of 96 bits in all, as only numbers can be aggregated without a sort.
    With `drop_unplaced=False` a blank machine is a machine of its own.
    """
    text = dict(df.dtypes)[machine] == "string"
    seen = [F.xxhash64(machine), F.crc32(F.encode(machine, "UTF-8"))] if text else [F.col(machine)]
    same = reduce(and_, (F.min(c).eqNullSafe(F.max(c)) for c in seen))
    # without blanks a null machine (numeric ids) still is a machine of its own
    mixed = F.count_if(F.col(machine).isNull()).between(1, F.count("*") - 1)
    per_job = (_placed(df, job, machine, drop_unplaced).groupBy(job)
               .agg((same & ~mixed).alias("same")))
    totals = per_job.agg(F.count_if("same").alias("same"), F.count("*").alias("total"))
    one, several = PLACEMENT_LABELS

    def row(label, n):
        return F.struct(F.lit(label).alias("category"), n.alias("count"),
                        share(n, "total", 100.0).alias("percentage"))

    return totals.select(F.inline(F.array(row(one, F.col("same")),
                                          row(several, F.col("total") - F.col("same")))))
