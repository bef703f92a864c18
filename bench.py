"""Times the registered queries on local[$BENCH_CPUS] and prints one JSON line.

For each query: building it (reading span) and running it into a sink that drops the rows
(processing span), median of BENCH_RUNS runs after a first one. Streams run when they are
built, so theirs is the time of both. `rec_per_s` is input rows per second of processing.
"""

import json
import os
import statistics
import sys
import time

from traceops.plans.tables import QUERIES
from traceops.session import session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = os.environ.get("BENCH_ONLY")

# headline queries and the tables they read
HEADLINE = {
    "a1_capacity_distribution": ["customer"],
    "a2_downtime_loss": ["events"],
    "a2_downtime_periods": ["events"],
    "a3_jobs_per_class": ["orders"],
    "a3_tasks_per_class": ["lineitem"],
    "a4_event_rate": ["lineitem"],
    "a5_detail": ["events", "orders"],
    "a5_correlation": ["events", "orders"],
    "a6_placement": ["lineitem"],
    "a7_join_correlation": ["orders", "events"],
    "a7_composite": ["lineitem"],
    "a8_peaks_vs_counts": ["lineitem"],
    "a9_hourly_profile": ["events"],
    "a10_stream_job_event_type": ["events"],
    "a11_stream_task_event_type": ["events"],
    "a12_stream_job_class": ["events"],
    "a13_stream_task_class": ["events"],
    "a14_event_text": ["events"],
    "a15_replay_schedule": ["events"],
    "a16_timing_report": ["lineitem"],
}
# the tables of the others are not needed: only their time is given
STREAMS = ("a10_", "a11_", "a12_", "a13_", "st1_", "st3_", "st7_")


def run(spark, name):
    start = time.perf_counter()
    df = QUERIES[name](spark, SF_DIR)
    built = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return built - start, time.perf_counter() - built


def main():
    spark = session("traceops-bench", master=f"local[{CPUS}]", shuffle_partitions=int(CPUS),
                    **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    rows = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count()
            for t in sorted({t for tables in HEADLINE.values() for t in tables})}
    names = [n for n in QUERIES if not ONLY or n in ONLY.split(",")]
    queries, reading, processing, rates = {}, {}, {}, {}
    for name in names:
        run(spark, name)
        times = [run(spark, name) for _ in range(RUNS)]
        read, process = (statistics.median(t[i] for t in times) for i in (0, 1))
        reading[name], processing[name] = round(read, 4), round(process, 4)
        queries[name] = round(read + process, 4)
        if name in HEADLINE:
            span = read + process if name.startswith(STREAMS) else process
            rates[name] = round(sum(rows[t] for t in HEADLINE[name]) / span)
        print(f"{name}: {queries[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "unit": "sec",
        "value": round(sum(queries[n] for n in HEADLINE if n in queries), 4),
        "queries": queries, "reading": reading, "processing": processing, "rec_per_s": rates,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS), "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
