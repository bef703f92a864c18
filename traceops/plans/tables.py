"""The operators bound to the test tables: one registered query each.

events play machine and task events (user = machine), orders and lineitem play jobs and
tasks. Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from traceops.functions.buckets import quarter
from traceops.functions.casts import filled, number, number_or_zero, whole
from traceops.functions.clock import hms, hms_seconds, minutes_label
from traceops.functions.stats import pearson
from traceops.functions.text import file_stem, human_count, number_in
from traceops.operators import capacity, classes, correlation, downtime, hourly, keyed, neighbours
from traceops.operators import placement, timing
from traceops.session import scratch_dir
from traceops.sources.events import encode_events, message_schema, parse_events
from traceops.sources.trace import row_count
from traceops.streaming import counts, gauges, letters, replay

JOB_TYPES = ("purchase", "signup")
# files, and so batches, that the events are streamed in
STREAM_PARTS = 3

# declared, so that reading starts no job that looks into the files
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
               "props STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _micros() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def _seconds() -> Column:
    return F.unix_seconds(F.col("ts").cast("timestamp"))


# --- A1 ------------------------------------------------------------------------

def a1_capacity_distribution(spark, d):
    return capacity.capacity_distribution(_table(spark, d, "customer"), F.col("c_acctbal") / 10000)


def a1_capacity_distribution_total(spark, d):
    return capacity.capacity_distribution(_table(spark, d, "customer"), F.col("c_acctbal") / 10000,
                                          mode="total")


# --- A2 ------------------------------------------------------------------------

def _machine_log(spark, d):
    return _table(spark, d, "events").select("event_id", _micros().alias("t"), "user_id", "event_type", "value")


_GAPS = dict(entity="user_id", ts="t", event="event_type", capacity="value", down="error",
             up="signup", tiebreak=["event_id"])


def a2_downtime_periods(spark, d):
    return downtime.downtime_periods(_machine_log(spark, d), **_GAPS)


def a2_downtime_periods_sliced(spark, d):
    """The same with slices of 20 rows, so that every key is cut."""
    return downtime.downtime_periods(_machine_log(spark, d), **_GAPS, slice_rows=20)


def a2_downtime_loss(spark, d):
    loss = downtime.downtime_loss(_machine_log(spark, d), **_GAPS)
    return loss.select(F.round(F.col("total_lost_power") / 1e6, 2).alias("total_lost_power"),
                       F.round(F.col("total_available_power") / 1e6, 0).alias("total_available_power"),
                       F.round("percentage_lost", 6).alias("percentage_lost"))


# --- A3, A4 ---------------------------------------------------------------------

def a3_jobs_per_class(spark, d):
    return classes.distinct_per_class(_table(spark, d, "orders"), "o_orderpriority", "o_custkey")


def a3_tasks_per_class(spark, d):
    return classes.distinct_per_class(_table(spark, d, "lineitem"), "l_returnflag", "l_orderkey")


def a3_rows_per_class(spark, d):
    return classes.rows_per_class(_table(spark, d, "lineitem"), "l_returnflag")


def a3_distinct_tasks_per_class(spark, d):
    return classes.distinct_per_class(_table(spark, d, "lineitem"), "l_returnflag",
                                      ["l_orderkey", "l_linenumber"])


def a4_event_rate(spark, d):
    return classes.event_rate_by_class(_table(spark, d, "lineitem"), "l_linestatus",
                                       F.col("l_returnflag") == "R")


# --- A5 ------------------------------------------------------------------------

_CAPACITIES = {"CPU Correlation": "cpu_capacity", "Memory Correlation": "memory_capacity"}


def _capacity_vs_hits(spark, d):
    log = _table(spark, d, "events").withColumnRenamed("user_id", "machine_id")
    newest = keyed.latest_per_key(log, "machine_id", ["ts", "event_id"], ["value", "props"], fill_zero=False)
    latest = newest.select("machine_id", (F.col("value") / 500).alias("cpu_capacity"),
                           (number(F.get_json_object("props", "$.k")) / 100).alias("memory_capacity"))
    orders = _table(spark, d, "orders").withColumnRenamed("o_custkey", "machine_id")
    hits = keyed.hits_per_key(orders, "machine_id", F.col("o_orderstatus") == "F").drop("event_count")
    return keyed.capacity_vs_hits(latest.na.fill(0.0), hits, "machine_id", _CAPACITIES)


def a5_detail(spark, d):
    return _capacity_vs_hits(spark, d)["detail"]


def a5_correlation(spark, d):
    return _capacity_vs_hits(spark, d)["correlations"].select("metric", F.round("value", 6).alias("value"))


def _rounded_means(df):
    return df.select("range", F.round("avg_evictions", 6).alias("avg_evictions"))


def a5_cpu_ranges(spark, d):
    return _rounded_means(_capacity_vs_hits(spark, d)["cpu_capacity_ranges"])


def a5_memory_ranges(spark, d):
    return _rounded_means(_capacity_vs_hits(spark, d)["memory_capacity_ranges"])


# --- A6 ------------------------------------------------------------------------

def a6_placement(spark, d):
    spread = placement.placement_spread(_table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")
    return spread.withColumn("percentage", F.round("percentage", 6))


def a6_machines_per_job(spark, d):
    return placement.machines_per_job(_table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


# --- A7 ------------------------------------------------------------------------

def _orders_and_events(spark, d):
    left = _table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_totalprice")
    right = _table(spark, d, "events").select(F.col("user_id").alias("k"), "value",
                                              number(F.get_json_object("props", "$.k")).alias("level"))
    return left, right


def _rounded(df, *cols):
    return df.select(F.col("pair_count").cast("bigint").alias("pair_count"),
                     *(F.round(c, 5).alias(c) for c in cols))


def a7_join_correlation(spark, d):
    left, right = _orders_and_events(spark, d)
    return _rounded(correlation.join_correlation(left, right, ["k"], {"cpu": ("o_totalprice", "value")}), "cpu")


def a7_join_correlation_stats(spark, d):
    """Two pairs in one pass, without the pass for centring."""
    left, right = _orders_and_events(spark, d)
    pairs = {"cpu": ("o_totalprice", "value"), "memory": ("o_totalprice", "level")}
    return _rounded(correlation.join_correlation(left, right, ["k"], pairs, center=False), *pairs)


def a7_composite(spark, d):
    rows = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                               "l_extendedprice", "l_returnflag")
    keys = ["l_orderkey", "l_linenumber"]
    pairs = {"cpu": ("l_quantity", "l_quantity"), "memory": ("l_extendedprice", "l_extendedprice")}
    return _rounded(correlation.join_correlation(
        rows.filter("l_returnflag = 'N'"), rows.filter("l_returnflag <> 'N'"), keys, pairs), *pairs)


def a7_sample(spark, d):
    """A sample of the joined rows, each with the ids of its two rows."""
    left = _table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_totalprice")
    right = _table(spark, d, "events").select(F.col("user_id").alias("k"), "event_id", "value")
    return correlation.sample_join(left, right, ["k"], left_order=["o_orderkey"], right_order=["event_id"])


def p15_plot_sample(spark, d):
    rows = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return correlation.plot_sample(rows, ["l_orderkey", "l_linenumber"])


# --- A8 ------------------------------------------------------------------------

_PEAKS = {"peak_cpu": "l_extendedprice", "peak_memory": "l_quantity"}


def _peaks(spark, d, hit, hit_only=False):
    rows = _table(spark, d, "lineitem")
    return keyed.peaks_vs_counts(rows, rows, "l_partkey", _PEAKS, hit, hit_only)


def a8_peaks_vs_counts(spark, d):
    detail = _peaks(spark, d, F.col("l_returnflag") == "R")
    return detail.agg(*(F.round(pearson(peak, n), 6).alias(f"{peak}_{n}")
                        for peak in _PEAKS for n in ("hit_count", "event_count")))


def a8_peaks_detail(spark, d):
    return _peaks(spark, d, F.col("l_returnflag") == "R")


def j4_hit_only_join(spark, d):
    hit = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    return _peaks(spark, d, hit, hit_only=True).select("l_partkey", "peak_cpu", "hit_count")


# --- A9 ------------------------------------------------------------------------

def a9_hourly_profile(spark, d):
    rows = _table(spark, d, "events").select(_seconds().alias("t"), "value")
    return hourly.hourly_profile(rows, "t", {"avg_value": "value"}).withColumn(
        "avg_value", F.round("avg_value", 6))


def a9_hourly_profile_us(spark, d):
    rows = _table(spark, d, "events").select(_micros().alias("t"), "value")
    return hourly.hourly_profile(rows, "t", {"avg_value": "value"}, "us").withColumn(
        "avg_value", F.round("avg_value", 6))


def a9_hourly_profile_us_as_s(spark, d):
    """Microseconds taken for seconds, as they stand."""
    rows = _table(spark, d, "events").select(_micros().alias("t"), "value")
    return hourly.hourly_profile(rows, "t", {"avg_value": "value"}, "s").withColumn("avg_value", F.round("avg_value", 6))


def a9_hourly_profiles(spark, d):
    """Both readings of the time from one pass."""
    rows = _table(spark, d, "events").select(_micros().alias("t"), "value")
    both = hourly.hourly_profiles(rows, "t", {"avg_value": "value"})
    parts = [df.select(F.lit(unit).alias("unit"), "hour", F.round("avg_value", 6).alias("avg_value")) for unit, df in both.items()]
    return parts[0].unionByName(parts[1])


# --- A10-A13, ST7: streams ---------------------------------------------------------

def _as_messages(events: DataFrame, kind: str) -> DataFrame:
    """Events as rows of the message layout, then as JSON."""
    values = {"timestamp": _seconds().cast("string"), "job_id": F.col("event_id").cast("string"),
              "event_type": F.col("event_type"), "user": F.col("user_id").cast("string"),
              "scheduling_class": (F.col("user_id") % 4).cast("string")}
    rows = events if kind == "task" else events.filter(F.col("event_type").isin(*JOB_TYPES))
    return encode_events(rows.select(*(values.get(f.name, F.lit("")).alias(f.name)
                                       for f in message_schema(kind))), kind)


def _streamed_counts(spark, d, kind, dim, hourly_times=False):
    """Runs the events through a stream of several batches: encoded, parsed, counted, written, read back."""
    work = scratch_dir(spark, f"{kind}-{dim}")
    # one table file would be one batch: parts by id, so times come back in later batches
    _table(spark, d, "events").repartitionByRange(STREAM_PARTS, "event_id").write.parquet(f"{work}/events")
    files = spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1)
    parsed = parse_events(_as_messages(files.parquet(f"{work}/events"), kind))
    if hourly_times:
        parsed = parsed.withColumn("event_timestamp", F.date_trunc("hour", "event_timestamp"))
    query = counts.start_counts(counts.stream_counts(parsed, dim), f"{work}/counts", f"{work}/state",
                                name=work.rsplit("/", 1)[1], mode="update", trigger={"availableNow": True})
    query.awaitTermination()
    return counts.read_counts(spark, f"{work}/counts", dim, mode="update")


def _by_second(df, dim):
    return df.select(F.unix_seconds("event_timestamp").alias("event_second"), dim, F.col("count"))


def a10_stream_job_event_type(spark, d):
    return _by_second(_streamed_counts(spark, d, "job", "event_type"), "event_type")


def a11_stream_task_event_type(spark, d):
    return _by_second(_streamed_counts(spark, d, "task", "event_type"), "event_type")


def a12_stream_job_class(spark, d):
    return _by_second(_streamed_counts(spark, d, "job", "scheduling_class"), "scheduling_class")


def a13_stream_task_class(spark, d):
    return _by_second(_streamed_counts(spark, d, "task", "scheduling_class"), "scheduling_class")


def st3_closed_hours(spark, d):
    """Hours that the watermark has closed, each given out once; the events come in order of time, in several batches."""
    work = scratch_dir(spark, "closed-hours")
    events = _table(spark, d, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / STREAM_PARTS
    for part in range(STREAM_PARTS):  # files of rising age, as a file stream takes them
        rows = events.filter((F.col("ts") >= first + part * step) & (
            (F.col("ts") < first + (part + 1) * step) if part < STREAM_PARTS - 1 else F.lit(True)))
        rows.coalesce(1).write.mode("append").parquet(f"{work}/events")
    files = spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1)
    parsed = parse_events(_as_messages(files.parquet(f"{work}/events"), "task"))
    closed = counts.stream_counts(parsed, "event_type", watermark="2 hours", window="1 hour")
    counts.start_counts(closed, f"{work}/counts", f"{work}/state", name=work.rsplit("/", 1)[1], mode="append",
                        trigger={"availableNow": True}).awaitTermination()
    return _by_second(counts.read_counts(spark, f"{work}/counts", mode="append"), "event_type")


def st1_dead_letters(spark, d):
    """Events sent as messages, some cut short, without a time or with one that no clock shows, sorted by a stream."""
    work = scratch_dir(spark, "letters")
    sent = _as_messages(_table(spark, d, "events"), "task")
    number = F.get_json_object("value", "$.job_id").cast("bigint")
    broken = (F.when(number % 10 == 3, F.substring("value", 1, 20)).when(number % 25 == 0, F.lit('{"job_id": "1"}'))
              .when(number % 40 == 7, F.regexp_replace("value", r'"timestamp":\d+', '"timestamp":9223372036854775807')).otherwise(F.col("value")))
    sent.select(broken.alias("value")).repartition(STREAM_PARTS, "value").write.text(f"{work}/messages")
    messages = spark.readStream.schema("value STRING").option("maxFilesPerTrigger", 1).text(f"{work}/messages")
    letters.start_letters(messages, f"{work}/tables", f"{work}/state", work.rsplit("/", 1)[1], "task", trigger={"availableNow": True}).awaitTermination()
    tables = letters.LetterTables(f"{work}/tables", "task")
    return (tables.broken.read(spark).select("reason").unionByName(tables.events.read(spark).select(F.lit("none").alias("reason")))
            .groupBy("reason").agg(F.count("*").alias("messages")))


def st7_latest_count(spark, d):
    return counts.latest_counts(_streamed_counts(spark, d, "task", "event_type", True), "event_type")


# --- A14, A15 -----------------------------------------------------------------------

def a14_encode(spark, d):
    """Encoded and parsed again, then counted."""
    parsed = parse_events(_as_messages(_table(spark, d, "events"), "task"))
    return classes.rows_per_class(parsed, "event_type")


def a14_json_text(spark, d):
    return _table(spark, d, "events").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("value"))


def a14_event_text(spark, d):
    """Whole messages of the job layout."""
    return _as_messages(_table(spark, d, "events"), "job")


def a15_replay_schedule(spark, d):
    rows = _table(spark, d, "events").select(_micros().alias("t"))
    return (replay.replay_schedule(rows, "t", speed=432_000, slot_ms=1, unit="us")
            .groupBy("slot").agg(F.count("*").alias("events")))


# --- A16-A18 ------------------------------------------------------------------------

def _timings(spark, d, name: Column):
    """A timing table out of lineitem: one 'job' per part, its times and records as metrics."""
    one = _table(spark, d, "lineitem").groupBy("l_partkey").agg(
        (F.sum(F.col("l_quantity").cast("bigint")) * 7).cast("double").alias("reading_time"),
        (F.sum(F.col("l_quantity").cast("bigint")) * 41 + 0.5).alias("processing_time"),
        (F.count("*") * 48_271 + F.col("l_partkey") * 50).alias("total_records"),
        F.count("*").alias("jobs_records"))
    metrics = ["reading_time", "processing_time", "total_records", "jobs_records"]
    # every third job has no reading time
    rows = one.select(name.alias("filename"), F.explode(F.array(*(
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics))).alias("m"),
        "l_partkey").filter("m.metric <> 'reading_time' or l_partkey % 3 <> 0")
    return rows.select("filename", "m.metric", "m.value")


def a16_timing_report(spark, d):
    return timing.timing_report(_timings(spark, d, F.format_string("q%d_perf", "l_partkey")))


def a17_worker_report(spark, d):
    return timing.worker_report(_timings(spark, d, F.format_string("rdd_q5_%d", "l_partkey")))


def o6_quickest_workers(spark, d):
    """The ten runs with the least processing time."""
    return timing.worker_report(_timings(spark, d, F.format_string("rdd_q5_%d", "l_partkey")), by_time=True, n=10)


def a18_row_count(spark, d):
    return row_count(_table(spark, d, "lineitem"))


# --- smaller pieces -------------------------------------------------------------------

def p2_safe_cast(spark, d):
    text = F.element_at(F.split("p_brand", "#"), 2)
    return _table(spark, d, "part").select(
        "p_partkey", number_or_zero(text).alias("brand"), number("p_brand").alias("bad"),
        number_or_zero("p_brand").alias("bad_as_zero"),
        whole(F.concat(text, F.lit(".7e1"))).alias("cut"), filled(text).alias("present"))


def p13_regex_filter(spark, d):
    return (_table(spark, d, "part").filter(~F.col("p_name").rlike("red|ring"))
            .groupBy("p_type").agg(F.count("*").alias("count")))


def p14_membership(spark, d):
    return _table(spark, d, "orders").filter(
        F.col("o_orderstatus").isin("F", "P") & F.col("o_orderpriority").endswith("H")).agg(
        F.count("*").alias("count"))


def p16_label_filter(spark, d):
    return gauges.with_label(u1_metric_union(spark, d), "event_type").select("label_value", "value")


def f2_quarter_bucket(spark, d):
    return _table(spark, d, "customer").select("c_custkey", quarter(F.col("c_acctbal") / 10000).alias("quarter"))


def f15_hms(spark, d):
    return _table(spark, d, "customer").select("c_custkey", hms(F.col("c_custkey") * 61).alias("text"))


def f16_hms_seconds(spark, d):
    return _table(spark, d, "customer").select("c_custkey", hms_seconds(hms("c_custkey")).alias("seconds"))


def f17_human(spark, d):
    """Odd steps and steps that end in exact halves."""
    return _table(spark, d, "orders").select(
        "o_orderkey", human_count(F.col("o_orderkey") * 1000 + 37).alias("text"),
        human_count(F.col("o_orderkey") * 50).alias("halves"),
        human_count(F.col("o_orderkey") * 50_000).alias("big_halves"))


def f18_name_number(spark, d):
    return _table(spark, d, "customer").select("c_custkey", number_in("c_name", r"#(\d+)").alias("number"),
                                               file_stem(F.concat(F.lit("a/b/"), F.col("c_name"))).alias("stem"))


def f21_mss(spark, d):
    return _table(spark, d, "customer").select("c_custkey", minutes_label("c_custkey").alias("text"))


def g17_pivot(spark, d):
    return (_table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"])
            .agg(F.count(F.lit(1))).na.fill(0))


def w3_last_per_key(spark, d):
    return keyed.last_value_per_key(_table(spark, d, "events"), "user_id", "ts", ["value"])


def w4_trailing_rate(spark, d):
    per_second = (_table(spark, d, "events").withColumn("t", _seconds()).groupBy("event_type", "t")
                  .agg(F.max_by("value", "event_id").alias("value")))
    return neighbours.trailing_rate(per_second, "event_type", "t", "value", 3600).withColumn(
        "rate", F.round("rate", 9))


def o4_topk(spark, d):
    rows = _table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return keyed.first_rows(rows, F.desc("o_totalprice"), "o_orderkey")


def u1_metric_union(spark, d):
    events = _table(spark, d, "events")

    def per(key, column):
        return (events.groupBy(column.cast("string").alias("label_value")).agg(F.count("*").alias("value"))
                .select(F.lit(key).alias("label_key"), "label_value", "value"))

    return gauges.all_gauges(per("event_type", F.col("event_type")),
                             per("scheduling_class", F.col("user_id") % 4))


def io11_exposition(spark, d):
    metrics = u1_metric_union(spark, d).withColumn("metric", F.lit("spark_streaming_task_count"))
    return gauges.to_exposition(metrics)


QUERIES = {f.__name__: f for f in (
    a1_capacity_distribution, a1_capacity_distribution_total,
    a2_downtime_periods, a2_downtime_periods_sliced, a2_downtime_loss,
    a3_jobs_per_class, a3_tasks_per_class, a3_rows_per_class, a3_distinct_tasks_per_class,
    a4_event_rate,
    a5_detail, a5_correlation, a5_cpu_ranges, a5_memory_ranges,
    a6_placement, a6_machines_per_job,
    a7_join_correlation, a7_join_correlation_stats, a7_composite, a7_sample,
    a8_peaks_vs_counts, a8_peaks_detail,
    a9_hourly_profile, a9_hourly_profile_us, a9_hourly_profile_us_as_s, a9_hourly_profiles,
    a10_stream_job_event_type, a11_stream_task_event_type, a12_stream_job_class, a13_stream_task_class,
    a14_encode, a14_json_text, a14_event_text, a15_replay_schedule,
    a16_timing_report, a17_worker_report, a18_row_count,
    p2_safe_cast, p13_regex_filter, p14_membership, p15_plot_sample, p16_label_filter,
    j4_hit_only_join, f2_quarter_bucket, f15_hms, f16_hms_seconds, f17_human, f18_name_number, f21_mss,
    g17_pivot, w3_last_per_key, w4_trailing_rate, o4_topk, o6_quickest_workers, u1_metric_union, io11_exposition,
    st1_dead_letters, st3_closed_hours, st7_latest_count,
)}
