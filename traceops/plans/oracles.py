"""DuckDB SQL with the results that the registered queries must give on the same tables."""

_GAPS = """
  WITH log AS (SELECT event_id, epoch_us(ts) AS t, user_id, event_type, value FROM events),
  seen AS (SELECT *, lag(event_type) OVER w AS before_type, lag(t) OVER w AS before_t,
                  lag(value) OVER w AS before_value
           FROM log WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
  gaps AS (SELECT user_id, before_t AS start, t AS "end", t - before_t AS offline_time,
                  (t - before_t) * before_value AS lost_power
           FROM seen WHERE event_type = 'signup' AND before_type = 'error')
"""

_DETAIL = """
  WITH latest AS (
    SELECT user_id AS machine_id, value / 500 AS cpu_capacity,
           CAST(props->>'$.k' AS DOUBLE) / 100 AS memory_capacity
    FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
  hits AS (
    SELECT o_custkey AS machine_id, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS hit_count
    FROM orders GROUP BY 1),
  detail AS (SELECT machine_id, cpu_capacity, memory_capacity, hit_count FROM latest JOIN hits USING (machine_id))
"""


def _quarter(c):
    return f"CASE WHEN {c} < 0.25 THEN 0 WHEN {c} < 0.5 THEN 1 WHEN {c} < 0.75 THEN 2 ELSE 3 END"


def _peaks(hit, hit_only=False):
    return f"""
  WITH peaks AS (SELECT l_partkey, max(l_extendedprice) AS peak_cpu, max(l_quantity) AS peak_memory
                 FROM lineitem GROUP BY 1),
  counts AS (SELECT l_partkey, count(*) AS event_count,
                    CAST(sum(CASE WHEN {hit} THEN 1 ELSE 0 END) AS BIGINT) AS hit_count
             FROM lineitem {"WHERE " + hit if hit_only else ""} GROUP BY 1),
  detail AS (SELECT * FROM peaks JOIN counts USING (l_partkey))
"""


def _hourly(unit):
    t = {"s": "epoch_us(ts) // 1000000 % 86400 // 3600", "us": "epoch_us(ts) // 1000000 % 86400 // 3600"}[unit]
    return (f"SELECT CAST({t} AS INTEGER) AS hour, round(avg(value), 6) AS avg_value "
            "FROM events GROUP BY 1 ORDER BY 1")


def _stream(dim, jobs):
    column = {"event_type": "event_type", "scheduling_class": "CAST(user_id % 4 AS VARCHAR)"}[dim]
    where = "WHERE event_type IN ('purchase', 'signup')" if jobs else ""
    return (f'SELECT epoch_us(ts) // 1000000 AS event_second, {column} AS {dim}, count(*) AS "count" '
            f"FROM events {where} GROUP BY 1, 2")


def _timings(name, extra="", number=r"q(\d+)", number_name="question"):
    return rf"""
  WITH one AS (
    SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) * 7 AS reading,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) * 41 AS processing,
           count(*) * 48271 + l_partkey * 50 AS records
    FROM lineitem GROUP BY l_partkey),
  report AS (
    SELECT printf('{name}', l_partkey) AS filename,
           CASE WHEN l_partkey % 3 = 0 THEN '-' ELSE
             printf('%02d:%02d:%02d', reading % 86400 // 3600, reading % 3600 // 60, reading % 60) END AS reading_time,
           printf('%02d:%02d:%02d', processing % 86400 // 3600, processing % 3600 // 60, processing % 60) AS processing_time,
           {_human("records")} AS total_records, processing % 86400 AS s
    FROM one)
  SELECT filename, reading_time, processing_time, total_records,
         CAST(regexp_extract(filename, '{number}', 1) AS INTEGER) AS {number_name} {extra}
  FROM report ORDER BY {number_name}, filename"""


def _human(n):
    return (f"CASE WHEN {n} >= 1000000 THEN printf('%.1fM', {n} / 1000000.0::DOUBLE) "
            f"WHEN {n} >= 1000 THEN printf('%.1fk', {n} / 1000.0::DOUBLE) ELSE CAST({n} AS VARCHAR) END")


_UNION = """
  SELECT 'event_type' AS label_key, event_type AS label_value, count(*) AS value FROM events GROUP BY event_type
  UNION ALL
  SELECT 'scheduling_class', CAST(user_id % 4 AS VARCHAR), count(*) FROM events GROUP BY user_id % 4
"""

_RANGES = "(VALUES ('0-20%', 0.0, 0.2), ('20-40%', 0.2, 0.4), ('40-60%', 0.4, 0.6), ('60-80%', 0.6, 0.8), ('80-100%', 0.8, 1.0)) r(range, low, high)"

ORACLES = {
    "a1_capacity_distribution": f"""
      SELECT r.range, count(c.x) AS "count" FROM {_RANGES}
      LEFT JOIN (SELECT c_acctbal / 10000 AS x FROM customer) c ON c.x > r.low::DOUBLE AND c.x <= r.high::DOUBLE
      GROUP BY r.range""",
    "a1_capacity_distribution_total": """
      SELECT CASE WHEN x <= 0.2 THEN '0-20%' WHEN x <= 0.4 THEN '20-40%' WHEN x <= 0.6 THEN '40-60%'
                  WHEN x <= 0.8 THEN '60-80%' ELSE '80-100%' END AS range, count(*) AS "count"
      FROM (SELECT c_acctbal / 10000 AS x FROM customer WHERE c_acctbal IS NOT NULL) GROUP BY 1""",
    "a2_downtime_periods": f"{_GAPS} SELECT * FROM gaps",
    "a2_downtime_periods_sliced": f"{_GAPS} SELECT * FROM gaps",
    "a2_downtime_loss": f"""{_GAPS},
      total AS (SELECT (max(t) - min(t)) * sum(CASE WHEN event_type = 'signup' THEN value END) AS available FROM log),
      lost AS (SELECT coalesce(sum(lost_power), 0) AS lost FROM gaps)
      SELECT round(lost / 1e6, 2) AS total_lost_power, round(available / 1e6, 0) AS total_available_power,
             round(100 * lost / available, 6) AS percentage_lost
      FROM total, lost""",
    "a3_jobs_per_class": """SELECT o_orderpriority, count(DISTINCT o_custkey) AS "count" FROM orders GROUP BY 1 ORDER BY 1""",
    "a3_tasks_per_class": """SELECT l_returnflag, count(DISTINCT l_orderkey) AS "count" FROM lineitem GROUP BY 1 ORDER BY 1""",
    "a3_rows_per_class": """SELECT l_returnflag, count(*) AS "count" FROM lineitem GROUP BY 1 ORDER BY 1""",
    "a3_distinct_tasks_per_class": """
      SELECT l_returnflag, count(*) AS "count"
      FROM (SELECT DISTINCT l_returnflag, l_orderkey, l_linenumber FROM lineitem) GROUP BY 1 ORDER BY 1""",
    "a4_event_rate": """
      SELECT l_linestatus, count(*) AS total, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS hits,
             round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*), 4) AS probability
      FROM lineitem GROUP BY 1 ORDER BY 1""",
    "a5_detail": f"{_DETAIL} SELECT * FROM detail",
    "a5_correlation": f"""{_DETAIL}
      SELECT 'CPU Correlation' AS metric, round(corr(cpu_capacity, hit_count), 6) AS value FROM detail
      UNION ALL SELECT 'Memory Correlation', round(corr(memory_capacity, hit_count), 6) FROM detail""",
    "a5_cpu_ranges": f"""{_DETAIL}
      SELECT {_quarter("cpu_capacity")} AS range, round(avg(hit_count), 6) AS avg_evictions FROM detail GROUP BY 1""",
    "a5_memory_ranges": f"""{_DETAIL}
      SELECT {_quarter("memory_capacity")} AS range, round(avg(hit_count), 6) AS avg_evictions FROM detail GROUP BY 1""",
    "a6_placement": """
      WITH per_job AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1),
      total AS (SELECT count(*) AS jobs, count(*) FILTER (n = 1) AS same FROM per_job)
      SELECT 'Same Machine' AS category, same AS "count", round(100.0 * same / jobs, 6) AS percentage FROM total
      UNION ALL SELECT 'Different Machines', jobs - same, round(100.0 * (jobs - same) / jobs, 6) FROM total""",
    "a6_machines_per_job": "SELECT l_orderkey, count(DISTINCT l_suppkey) AS machine_count FROM lineitem GROUP BY 1",
    "a7_join_correlation": """
      SELECT count(*) AS pair_count, round(corr(o_totalprice, value), 5) AS cpu
      FROM orders JOIN events ON o_custkey = user_id""",
    "a7_join_correlation_stats": """
      SELECT count(*) AS pair_count, round(corr(o_totalprice, value), 5) AS cpu,
             round(corr(o_totalprice, CAST(props->>'$.k' AS DOUBLE)), 5) AS memory
      FROM orders JOIN events ON o_custkey = user_id""",
    "a7_composite": """
      SELECT count(*) AS pair_count, round(corr(a.l_quantity, b.l_quantity), 5) AS cpu,
             round(corr(a.l_extendedprice, b.l_extendedprice), 5) AS memory
      FROM lineitem a JOIN lineitem b USING (l_orderkey, l_linenumber)
      WHERE a.l_returnflag = 'N' AND b.l_returnflag <> 'N'""",
    "a7_sample": """
      WITH l AS (SELECT o_custkey AS k, o_orderkey, o_totalprice, md5('=' || CAST(o_orderkey AS VARCHAR)) AS digest FROM orders),
      r AS (SELECT user_id AS k, event_id, value, md5('=' || CAST(event_id AS VARCHAR)) AS digest FROM events),
      ranked_l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY digest) - 1 AS rank FROM l),
      ranked_r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY digest) - 1 AS rank FROM r),
      sizes AS (
        SELECT k, nl, nr, CAST(nl AS HUGEINT) * nr AS pairs, substr(md5('=' || CAST(k AS VARCHAR)), 1, 3) AS part
        FROM (SELECT k, count(*) AS nl FROM l GROUP BY k) JOIN (SELECT k, count(*) AS nr FROM r GROUP BY k) USING (k)),
      placed AS (SELECT *, sum(pairs) OVER (ORDER BY part, k) - pairs AS start FROM sizes),
      total AS (SELECT sum(pairs) AS p, least(10000, CAST(ceil(CAST(sum(pairs) AS DOUBLE) * 0.01) AS BIGINT)) AS m FROM sizes),
      stretches AS (SELECT p, m, unnest(range(m)) AS j FROM total),
      numbers AS (
        SELECT j * p // m + CAST('0x' || substr(md5('42:' || CAST(j AS VARCHAR)), 1, 8) AS BIGINT) * ((j + 1) * p // m - j * p // m) // 4294967296 AS number
        FROM stretches),
      chosen AS (SELECT k, (number - start) // nr AS lr, (number - start) % nr AS rr FROM numbers JOIN placed ON number >= start AND number < start + pairs)
      SELECT k, o_orderkey, o_totalprice, event_id, value
      FROM chosen JOIN ranked_l USING (k) JOIN ranked_r USING (k) WHERE ranked_l.rank = lr AND ranked_r.rank = rr""",
    "p15_plot_sample": """
      WITH hashed AS (
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
               md5('=' || CAST(l_orderkey AS VARCHAR) || '|=' || CAST(l_linenumber AS VARCHAR)) AS digest
        FROM lineitem)
      SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM hashed
      WHERE digest < '028f5c28f5c2' ORDER BY digest, l_orderkey, l_linenumber LIMIT 10000""",
    "a8_peaks_vs_counts": _peaks("l_returnflag = 'R'") + """
      SELECT round(corr(peak_cpu, hit_count), 6) AS peak_cpu_hit_count,
             round(corr(peak_cpu, event_count), 6) AS peak_cpu_event_count,
             round(corr(peak_memory, hit_count), 6) AS peak_memory_hit_count,
             round(corr(peak_memory, event_count), 6) AS peak_memory_event_count FROM detail""",
    "a8_peaks_detail": _peaks("l_returnflag = 'R'") + " SELECT * FROM detail",
    "j4_hit_only_join": _peaks("l_returnflag = 'R' AND l_quantity > 45", True)
        + " SELECT l_partkey, peak_cpu, hit_count FROM detail",
    "a9_hourly_profile": _hourly("s"),
    "a9_hourly_profile_us": _hourly("us"),
    "a9_hourly_profile_us_as_s": """
      SELECT CAST(epoch_us(ts) % 86400 // 3600 AS INTEGER) AS hour, round(avg(value), 6) AS avg_value FROM events GROUP BY 1""",
    "a9_hourly_profiles": """
      SELECT 's' AS unit, CAST(epoch_us(ts) % 86400 // 3600 AS INTEGER) AS hour, round(avg(value), 6) AS avg_value FROM events GROUP BY ALL
      UNION ALL SELECT 'us', CAST(epoch_us(ts) // 1000000 % 86400 // 3600 AS INTEGER), round(avg(value), 6) FROM events GROUP BY ALL""",
    "a10_stream_job_event_type": _stream("event_type", True),
    "a11_stream_task_event_type": _stream("event_type", False),
    "a12_stream_job_class": _stream("scheduling_class", True),
    "a13_stream_task_class": _stream("scheduling_class", False),
    "st1_dead_letters": """
      SELECT CASE WHEN event_id % 10 = 3 THEN 'not JSON' WHEN event_id % 25 = 0 THEN 'no time' WHEN event_id % 40 = 7 THEN 'time out of range'
                  ELSE 'none' END AS reason, count(*) AS messages FROM events GROUP BY 1""",
    "st3_closed_hours": """
      WITH hours AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n FROM events GROUP BY 1, 2),
      mark AS (SELECT to_timestamp(epoch_us(max(ts)) // 1000000)::TIMESTAMP - INTERVAL 2 HOUR AS closed FROM events)
      SELECT epoch_us(h) // 1000000 AS event_second, event_type, n AS "count" FROM hours, mark WHERE h + INTERVAL 1 HOUR <= closed""",
    "st7_latest_count": """
      WITH hourly AS (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1, 2)
      SELECT event_type, arg_max(n, h) AS "count" FROM hourly GROUP BY 1""",
    "a14_encode": """SELECT event_type, count(*) AS "count" FROM events GROUP BY 1 ORDER BY 1""",
    "a14_json_text": "SELECT event_id, CAST(to_json({event_id: event_id, event_type: event_type}) AS VARCHAR) AS value FROM events",
    "a14_event_text": """
      SELECT CAST(to_json({timestamp: epoch_us(ts) // 1000000, missing_type: '', job_id: CAST(event_id AS VARCHAR),
               event_type: event_type, user: CAST(user_id AS VARCHAR), scheduling_class: CAST(user_id % 4 AS VARCHAR),
               job_name: '', logical_job_name: ''}) AS VARCHAR) AS value
      FROM events WHERE event_type IN ('purchase', 'signup')""",
    "a15_replay_schedule": """
      SELECT CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events))::DOUBLE * 1000
                        / (1000000::BIGINT * 432000)) AS BIGINT) AS slot, count(*) AS events
      FROM events GROUP BY 1""",
    "a16_timing_report": _timings("q%d_perf"),
    "a17_worker_report": _timings("rdd_q5_%d", ", s AS processing_seconds, printf('%d:%02d', s // 60, s % 60) AS label",
                                  r"q5_(\d+)", "cores"),
    "o6_quickest_workers": "SELECT * FROM (" + _timings(
        "rdd_q5_%d", ", s AS processing_seconds, printf('%d:%02d', s // 60, s % 60) AS label", r"q5_(\d+)", "cores")
        + ") ORDER BY processing_seconds, cores LIMIT 10",
    "a18_row_count": "SELECT count(*) AS row_count FROM lineitem",
    "p2_safe_cast": """
      SELECT p_partkey, coalesce(TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE), 0.0) AS brand,
             TRY_CAST(p_brand AS DOUBLE) AS bad, 0.0::DOUBLE AS bad_as_zero,
             CAST(trunc(CAST(split_part(p_brand, '#', 2) || '.7e1' AS DOUBLE)) AS BIGINT) AS cut,
             trim(split_part(p_brand, '#', 2)) <> '' AS present
      FROM part""",
    "p13_regex_filter": """
      SELECT p_type, count(*) AS "count" FROM part WHERE NOT regexp_matches(p_name, 'red|ring') GROUP BY 1""",
    "p14_membership": """
      SELECT count(*) AS "count" FROM orders WHERE o_orderstatus IN ('F', 'P') AND suffix(o_orderpriority, 'H')""",
    "p16_label_filter": f"SELECT label_value, value FROM ({_UNION}) WHERE label_key = 'event_type' AND label_value <> ''",
    "f2_quarter_bucket": f"SELECT c_custkey, {_quarter('c_acctbal / 10000')} AS quarter FROM customer",
    "f15_hms": """
      SELECT c_custkey, printf('%02d:%02d:%02d', c_custkey * 61 % 86400 // 3600, c_custkey * 61 % 3600 // 60,
                               c_custkey * 61 % 60) AS text FROM customer""",
    "f16_hms_seconds": "SELECT c_custkey, c_custkey % 86400 AS seconds FROM customer",
    "f17_human": f"""
      SELECT o_orderkey, {_human("(o_orderkey * 1000 + 37)")} AS text, {_human("(o_orderkey * 50)")} AS halves,
             {_human("(o_orderkey * 50000)")} AS big_halves FROM orders""",
    "f18_name_number": r"""
      SELECT c_custkey, CAST(nullif(regexp_extract(c_name, '#(\d+)', 1), '') AS INTEGER) AS number,
             substr(c_name, 1, 10) AS stem FROM customer""",
    "f21_mss": "SELECT c_custkey, printf('%d:%02d', c_custkey // 60, c_custkey % 60) AS text FROM customer",
    "g17_pivot": """
      SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
             count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""",
    "w3_last_per_key": "SELECT user_id, arg_max(value, ts) AS value FROM events GROUP BY 1",
    "w4_trailing_rate": """
      WITH per_second AS (
        SELECT event_type, epoch_us(ts) // 1000000 AS t, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2),
      seen AS (SELECT *, first_value(value) OVER w AS v0, first_value(t) OVER w AS t0 FROM per_second
               WINDOW w AS (PARTITION BY event_type ORDER BY t RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW))
      SELECT event_type, t, value, round((value - v0) / nullif(t - t0, 0), 9) AS rate FROM seen""",
    "o4_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "u1_metric_union": _UNION,
    "io11_exposition": f"""
      SELECT '# TYPE spark_streaming_task_count gauge' AS line
      UNION ALL SELECT printf('spark_streaming_task_count{{%s="%s"}} %d', label_key, label_value, value) FROM ({_UNION})""",
}
