"""Reports over the timing files that jobs write."""

from pyspark.sql import DataFrame, functions as F

from traceops.fixed_values import JOB_NUMBER, SPLIT_RECORD_METRICS, TIME_METRICS, WORKER_NUMBER
from traceops.functions.casts import number, whole
from traceops.functions.clock import hms, minutes_label
from traceops.functions.text import human_count, number_in

REPORT_METRICS = [*TIME_METRICS, "total_records"]


def timing_report(timings: DataFrame, id_regex=JOB_NUMBER, id_name="question",
                  metrics=None) -> DataFrame:
    """One readable row per file, ordered by the number in its name.

    `timings` has `(filename, metric, value)`, and `file` where names are cut. Times become `HH:MM:SS`, record counts `1.2M`,
    missing metrics `-`; record counts of single tables are left out.
    """
    return _report(timings, id_regex, id_name, metrics or REPORT_METRICS).drop("_seconds")


def _report(timings, id_regex, id_name, metrics):
    # a run is a whole file; the shown name is cut and may be the same for several runs
    key = "file" if "file" in timings.columns else "filename"
    wide = (timings.filter(~F.col("metric").rlike(SPLIT_RECORD_METRICS))
            .select(F.col(key).alias("_file"), "filename", "metric", number("value").alias("value"))
            .groupBy("_file", "filename").pivot("metric", metrics).agg(F.max("value")))

    def readable(metric):
        if metric in TIME_METRICS:
            return hms(metric)
        return human_count(whole(metric)) if metric.endswith("_records") else F.col(metric).cast("string")

    seconds = F.floor("processing_time") if "processing_time" in metrics else F.lit(None).cast("bigint")
    number_of = number_in(F.element_at(F.split("_file", "/"), -1), id_regex)
    return (wide.select("_file", "filename", *(F.coalesce(readable(m), F.lit("-")).alias(m) for m in metrics),
                        number_of.alias(id_name), seconds.alias("_seconds"))
            .orderBy(F.asc_nulls_last(id_name), "filename", "_file").drop("_file"))


def worker_report(timings: DataFrame, id_regex=WORKER_NUMBER, by_time=False, n=None) -> DataFrame:
    """Timing report per number of workers, with the points and labels of its curve.

    Seconds are those of the file, also beyond a day, where the shown time starts anew. `by_time` puts the quickest first (runs of one time by
    number of workers and name, those without a time last), `n` keeps the first so many.
    """
    report = (_report(timings, id_regex, "cores", REPORT_METRICS).withColumnRenamed("_seconds", "processing_seconds")
              .withColumn("label", minutes_label("processing_seconds")))
    if by_time:
        report = report.orderBy(F.asc_nulls_last("processing_seconds"), F.asc_nulls_last("cores"), "filename")
    return report if n is None else report.limit(n)
