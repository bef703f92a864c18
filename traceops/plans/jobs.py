"""The nine analyses and the row count over trace tables, as jobs with results and timings."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from traceops.fixed_values import CAPACITY_LABELS, PEAK_LABELS, REQUEST_LABELS, RESULT_PREFIXES, TASK_EVICT
from traceops.operators import capacity, classes, correlation, downtime, hourly, keyed, placement
from traceops.sources.sinks import ResultSink
from traceops.sources.trace import read_trace, row_count

Tables = dict[str, DataFrame]
# a result, and whether it has few enough rows for one file
Result = tuple[DataFrame, bool]
# marks a frame that several results of a job are made from
Keep = Callable[[DataFrame], DataFrame]


def _evicted():
    return F.col("event_type") == TASK_EVICT


def machine_capacity(t: Tables, keep: Keep) -> dict[str, Result]:
    return {"machine_distribution": (
        capacity.capacity_distribution(t["machine_events"], "cpu_capacity"), True)}


def machine_capacity_total(t: Tables, keep: Keep) -> dict[str, Result]:
    return {"machine_distribution_total": (
        capacity.capacity_distribution(t["machine_events"], "cpu_capacity", mode="total"), True)}


def lost_power(t: Tables, keep: Keep) -> dict[str, Result]:
    return {"power_loss": (downtime.downtime_loss(
        t["machine_events"].withColumn("machine_id", F.col("machine_id").try_cast("bigint")),
        "machine_id", "timestamp", "event_type", "cpu_capacity", tiebreak=["event_type"]), True)}


def scheduling_classes(t: Tables, keep: Keep) -> dict[str, Result]:
    return {
        "jobs_distribution": (classes.distinct_per_class(t["job_events"], "scheduling_class", "job_id"), True),
        "tasks_distribution": (classes.distinct_per_class(t["task_events"], "scheduling_class", "job_id"), True),
    }


def eviction_probability(t: Tables, keep: Keep) -> dict[str, Result]:
    rates = classes.event_rate_by_class(t["task_events"], "scheduling_class", _evicted())
    return {"eviction_probability": (rates.select(
        "scheduling_class", F.col("total").alias("total_tasks"), F.col("hits").alias("evicted_tasks"),
        "probability"), True)}


def capacity_evictions(t: Tables, keep: Keep) -> dict[str, Result]:
    machines = keyed.latest_per_key(t["machine_events"], "machine_id", ["timestamp", "event_type"],
                                    ["cpu_capacity", "memory_capacity"])
    hits = keyed.hits_per_key(t["task_events"], "machine_id", _evicted())
    detail = keep(machines.join(hits.drop("event_count"), "machine_id")
                  .withColumnRenamed("hit_count", "eviction_count"))
    values = dict(zip(CAPACITY_LABELS, ("cpu_capacity", "memory_capacity")))
    results = keyed.from_detail(detail, values, "eviction_count")
    return {
        "detailed_results": (keyed.first_rows(detail, "machine_id"), True),
        "all_detailed_results": (detail, False),
        "correlations": (results["correlations"], True),
        "cpu_range_averages": (results["cpu_capacity_ranges"], True),
        "memory_range_averages": (results["memory_capacity_ranges"], True),
    }


def job_machines(t: Tables, keep: Keep) -> dict[str, Result]:
    return {"job_machine_distribution": (
        placement.placement_spread(t["task_events"], "job_id", "machine_id"), True)}


def job_machines_with_blanks(t: Tables, keep: Keep) -> dict[str, Result]:
    return {"job_machine_distribution_with_blanks": (
        placement.placement_spread(t["task_events"], "job_id", "machine_id", drop_unplaced=False), True)}


def _requests_and_usage(t: Tables):
    requests = t["task_events"].select("job_id", "task_index", "cpu_request", "memory_request").dropna()
    usage = t["task_usage"].select("job_id", "task_index", "cpu_rate", "memory_usage").dropna()
    return requests, usage, ["job_id", "task_index"]


def request_correlation(t: Tables, keep: Keep) -> dict[str, Result]:
    requests, usage, keys = _requests_and_usage(t)
    cpu, memory = REQUEST_LABELS
    # trace values are normalised to 0..1
    wide = correlation.join_correlation(
        requests, usage, keys,
        {cpu: ("cpu_request", "cpu_rate"), memory: ("memory_request", "memory_usage")}, center=False)
    rows = wide.select(F.inline(F.array(*(
        F.struct(F.lit(label).alias("resource"), F.col(label).alias("correlation"))
        for label in REQUEST_LABELS))))
    return {"resource_correlation": (rows, True),
            "plot_sample": (correlation.sample_join(requests, usage, keys), False)}


def _peaks(t: Tables, hit_only=False) -> DataFrame:
    return keyed.peaks_vs_counts(t["task_usage"], t["task_events"], "machine_id",
                                 {"peak_cpu": "cpu_rate", "peak_memory": "memory_usage"}, _evicted(), hit_only)


def peak_evictions_hit_only(t: Tables, keep: Keep) -> dict[str, Result]:
    """Of machines with evictions only."""
    detail = keep(_peaks(t, hit_only=True))
    pairs = {label: (c, "hit_count") for label, c in zip(PEAK_LABELS, ("peak_cpu", "peak_memory"))}
    return {
        "peaks_evictions_hit_only": (keyed.correlations(detail, pairs, ("resource", "correlation")), True),
        "peaks_evictions_hit_only_all": (detail.drop("event_count"), False),
    }


def peak_evictions(t: Tables, keep: Keep) -> dict[str, Result]:
    detail = keep(_peaks(t))
    # the published figures relate peaks to all events of a machine; evictions are beside them
    pairs = {label: (c, "event_count") for label, c in zip(PEAK_LABELS, ("peak_cpu", "peak_memory"))}
    hits = {label: (c, "hit_count") for label, c in zip(PEAK_LABELS, ("peak_cpu", "peak_memory"))}
    names = ("resource", "correlation")
    sample = keyed.first_rows(detail, "machine_id").select(
        "machine_id", "peak_cpu", "peak_memory", F.col("event_count"), F.col("hit_count").alias("eviction_count"))
    return {
        "peaks_evictions": (keyed.correlations(detail, pairs, names), True),
        "peaks_evictions_only": (keyed.correlations(detail, hits, names), True),
        "peaks_evictions_sample": (sample, True),
        "peaks_evictions_all": (detail, False),
    }


def hourly_resources(t: Tables, keep: Keep) -> dict[str, Result]:
    cols = {"avg_cpu": "cpu_rate", "avg_memory": "memory_usage"}
    means = hourly.hourly_profiles(t["task_usage"], "start_time", cols, ("s", "us"), keep)
    return {"hourly_resources": (means["s"], True), "hourly_resources_us": (means["us"], True)}


def count_rows(t: Tables, keep: Keep) -> dict[str, Result]:
    return {"row_count": (row_count(t["machine_events"]), True)}


@dataclass(frozen=True)
class Job:
    tables: tuple[str, ...]
    run: Callable[[Tables, Keep], dict[str, Result]]
    variants: dict[str, Callable[[Tables, Keep], dict[str, Result]]] = field(default_factory=dict)


JOBS = {
    "a1": Job(("machine_events",), machine_capacity, {"total": machine_capacity_total}),
    "a2": Job(("machine_events",), lost_power),
    "a3": Job(("job_events", "task_events"), scheduling_classes),
    "a4": Job(("task_events",), eviction_probability),
    "a5": Job(("machine_events", "task_events"), capacity_evictions),
    "a6": Job(("task_events",), job_machines, {"with-blanks": job_machines_with_blanks}),
    "a7": Job(("task_events", "task_usage"), request_correlation),
    "a8": Job(("task_usage", "task_events"), peak_evictions, {"hit-only": peak_evictions_hit_only}),
    "a9": Job(("task_usage",), hourly_resources),
    "a18": Job(("machine_events",), count_rows),
}


def run_job(spark: SparkSession, name: str, source: str, output: str, fmt="csv",
            epoch: int | None = None, variant: str | None = None) -> dict[str, str]:
    """Reads `<source>/<table>`, writes results and timings below `output`; names -> paths.

    Records are counted as the first result that needs a table reads it, not by a scan of their own. `variant` names another
    form of the analysis.
    """
    job, prefix, sink = JOBS[name], RESULT_PREFIXES[name], ResultSink(spark, output, epoch)
    analysis = job.variants[variant] if variant else job.run
    start = time.perf_counter()
    counted = {t: Observation(f"{name}_{t}_{uuid.uuid4().hex}") for t in job.tables}
    tables = {t: read_trace(spark, f"{source.rstrip('/')}/{t}", t, fmt=fmt).observe(counted[t], F.count(F.lit(1)).alias("records"))
              for t in job.tables}
    reading = time.perf_counter() - start

    kept = []

    def keep(df):
        kept.append(df.persist())
        return kept[-1]

    start = time.perf_counter()
    written = {}
    for result, (df, bounded) in analysis(tables, keep).items():
        written[result] = sink.save(df, f"{prefix}_{result}", one_file=bounded)
    metrics = {"reading_time": reading, "processing_time": time.perf_counter() - start}
    for df in kept:
        df.unpersist()
    records = {t: count.get["records"] for t, count in counted.items()}
    if name == "a3":
        metrics.update(jobs_records=records["job_events"], tasks_records=records["task_events"])
    metrics["total_records"] = sum(records.values())
    written["performance"] = sink.save_metrics(prefix, metrics)
    return written
