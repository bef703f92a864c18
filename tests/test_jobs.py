"""Every job over a small trace: results by hand, files and columns as published."""

import gzip
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, functions as F

from traceops.operators.timing import timing_report, worker_report
from traceops.plans.jobs import JOBS, run_job
from traceops.sources.trace import read_timings

DAY = 86_400_000_000
MACHINES = [
    "0,m1,0,p,0.5,0.5", "0,m2,0,p,0.25,0.75", "0,m3,0,p,1.0,1.0",
    "100,m1,1,p,0.5,0.5", "160,m1,0,p,0.5,0.6", "500,m2,2,p,0.3,0.75", "1000,m3,1,p,,",
]
MACHINES = [m.replace("m", "", 1) for m in MACHINES]
JOBS_ROWS = ["0,,a,0,u,0,n,l", "1,,a,1,u,0,n,l", "2,,b,0,u,3,n,l", "3,,c,0,u,,n,l"]
TASKS = [
    "1,,a,0,1,2,u,0,9,0.5,0.1,0.1", "2,,a,1,2,2,u,0,9,0.1,0.2,0.1", "3,,b,0,2,2,u,3,9,0.3,0.3,0.1",
    "4,,b,0,2,4,u,3,9,0.4,0.3,0.1", "5,,c,0,,0,u,1,9,,,", "6,,a,0,1,1,u,0,9,0.6,0.2,0.1",
]
USAGE = [
    f"{3600 * 10**6},x,a,0,1,0.2,0.1", f"{3600 * 10**6 + 5},x,a,0,1,0.4,0.3", f"{DAY},x,b,0,2,0.9,0.2",
    "7,x,a,1,2,0.1,0.6", "8,x,c,0,9,,0.6",
]


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    root = tmp_path_factory.mktemp("trace")
    for table, lines in (("machine_events", MACHINES), ("job_events", JOBS_ROWS), ("task_events", TASKS),
                         ("task_usage", USAGE)):
        (root / table).mkdir()
        with gzip.open(root / table / "part-00000-of-00001.csv.gz", "wt") as f:
            f.write("\n".join(lines) + "\n")
    return str(root)


@pytest.fixture
def run(spark, source, tmp_path):
    def go(name):
        written = run_job(spark, name, source, str(tmp_path), epoch=1700000000)
        return {k: spark.read.option("header", True).option("inferSchema", True).csv(p) for k, p in written.items()}
    return go


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_a1(run):
    got = run("a1")["machine_distribution"]
    assert got.columns == ["range", "count"]
    assert rows(got) == [("0-20%", 0), ("20-40%", 2), ("40-60%", 3), ("60-80%", 0), ("80-100%", 1)]


def test_a2(run):
    got = run("a2")["power_loss"]
    assert got.columns == ["total_lost_power", "total_available_power", "percentage_lost"]
    assert rows(got) == [(pytest.approx(30.0), pytest.approx(2250.0), pytest.approx(100 * 30 / 2250))]


def test_a3(run):
    got = run("a3")
    assert got["jobs_distribution"].columns == ["scheduling_class", "count"]
    assert rows(got["jobs_distribution"]) == [(0, 1), (3, 1)]
    assert rows(got["tasks_distribution"]) == [(0, 1), (1, 1), (3, 1)]
    metrics = dict(rows(got["performance"]))
    assert (metrics["jobs_records"], metrics["tasks_records"], metrics["total_records"]) == (4, 6, 10)


def test_a4(run):
    got = run("a4")["eviction_probability"]
    assert got.columns == ["scheduling_class", "total_tasks", "evicted_tasks", "probability"]
    assert rows(got) == [(0, 3, 2, 0.6667), (1, 1, 0, 0.0), (3, 2, 1, 0.5)]


def test_a5(run):
    got = run("a5")
    assert rows(got["detailed_results"]) == [(1, 0.5, 0.6, 1), (2, 0.3, 0.75, 2)]
    assert got["detailed_results"].columns == ["machine_id", "cpu_capacity", "memory_capacity", "eviction_count"]
    assert rows(got["correlations"]) == [("CPU Correlation", pytest.approx(-1)), ("Memory Correlation", pytest.approx(1))]
    assert rows(got["cpu_range_averages"]) == [(1, 2.0), (2, 1.0)]
    assert rows(got["memory_range_averages"]) == [(2, 1.0), (3, 2.0)]


def test_a6(run):
    assert rows(run("a6")["job_machine_distribution"]) == [("Same Machine", 1, 50.0), ("Different Machines", 1, 50.0)]


def test_a7(run):
    got = run("a7")
    import numpy as np
    requests = {("a", 0): [(.5, .1), (.6, .2)], ("a", 1): [(.1, .2)], ("b", 0): [(.3, .3), (.4, .3)]}
    usage = {("a", 0): [(.2, .1), (.4, .3)], ("a", 1): [(.1, .6)], ("b", 0): [(.9, .2)]}
    pairs = np.array([r + u for k in usage for r in requests[k] for u in usage[k]])
    want = [np.corrcoef(pairs[:, 0], pairs[:, 2])[0, 1], np.corrcoef(pairs[:, 1], pairs[:, 3])[0, 1]]
    assert rows(got["resource_correlation"]) == [("CPU", pytest.approx(want[0])), ("Memory", pytest.approx(want[1]))]


def test_a8(run):
    got = run("a8")
    assert rows(got["peaks_evictions_sample"]) == [(1, 0.4, 0.3, 2, 1), (2, 0.9, 0.6, 3, 2)]
    assert rows(got["peaks_evictions"]) == [("CPU peaks", pytest.approx(1)), ("Memory peaks", pytest.approx(1))]
    assert got["peaks_evictions"].columns == ["resource", "correlation"]


def test_a9(run):
    got = run("a9")
    assert rows(got["hourly_resources_us"]) == [(0, pytest.approx(0.5), pytest.approx(0.4)),
                                                (1, pytest.approx(0.3), pytest.approx(0.2))]
    hours = {t % 86400 // 3600 for t in (3600 * 10**6, 3600 * 10**6 + 5, DAY, 7)}
    assert {r.hour for r in got["hourly_resources"].collect()} == hours


def test_a18(run):
    assert rows(run("a18")["row_count"]) == [(7,)]


def test_timing_files_of_jobs_feed_the_report(spark, source, tmp_path):
    for name in ("a4", "a3", "a1"):
        run_job(spark, name, source, str(tmp_path), epoch=1700000000)
    got = timing_report(read_timings(spark, f"{tmp_path}/performance")).collect()
    assert [(r.question, r.filename, r.total_records) for r in got] == [
        (1, "q1_perform", "7"), (3, "q3_perform", "10"), (4, "q4_perform", "6")]
    assert all(r.processing_time.startswith("00:00:") for r in got)


def test_reports_over_timing_files(spark, tmp_path):
    files = {
        "rdd_q5_14": [("reading_time", 2.27), ("processing_time", 187.86), ("total_records", 144686068)],
        "rdd_q5_3": [("reading_time", 1.41), ("processing_time", 420.38), ("total_records", 37780.0),
                     ("jobs_records", 5), ("tasks_records", 6)],
        "smoke": [("processing_time", 3600)],
    }
    for name, metrics in files.items():
        (tmp_path / f"{name}.csv").write_text("metric,value\n" + "".join(f"{m},{v}\n" for m, v in metrics))
    timings = read_timings(spark, str(tmp_path))
    assert [tuple(r) for r in timing_report(timings).collect()] == [
        ("rdd_q5_14.", "00:00:02", "00:03:07", "144.7M", 5),
        ("rdd_q5_3.c", "00:00:01", "00:07:00", "37.8k", 5),
        ("smoke.csv", "-", "01:00:00", "-", None)]
    got = worker_report(timings.filter("filename <> 'smoke.csv'")).collect()
    assert [(r.cores, r.processing_seconds, r.label) for r in got] == [(3, 420, "7:00"), (14, 187, "3:07")]


def test_command_line(source, tmp_path):
    repo = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, str(repo / "run.py"), "a4", "--input", source, "--output-dir", str(tmp_path)],
                          capture_output=True, text=True, timeout=200, cwd=repo)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "eviction_probability: " in done.stdout
    assert list((tmp_path / "data").glob("q4_eviction_probability_*.csv/part-*.csv"))


def test_every_analysis_has_a_job():
    assert list(JOBS) == [*(f"a{i}" for i in range(1, 10)), "a18"]


def test_replay_and_stream_from_the_command_line(spark, source, tmp_path, capsys):
    from run import arguments, run
    from traceops.streaming.counts import read_counts

    bad = Path(source) / "job_events" / "part-00001.csv.gz"
    with gzip.open(bad, "wt") as f:
        f.write("late,,z,0,u,0,n,l\n9,,z,0\n9,,z,7,u,2,n,l\n")
    run(spark, arguments(["replay", "--input", source, "--target", f"{tmp_path}/topics", "--num-files", "2",
                          "--waves", "2", "--speed-factor", "1"]))
    assert "job: rejected rows 2" in capsys.readouterr().out
    run(spark, arguments(["stream", "--source", f"{tmp_path}/topics", "--output-dir", f"{tmp_path}/live",
                          "--available-now"]))
    out = capsys.readouterr().out
    assert "spark_streaming_job_events_num_input_rows" in out
    assert 'spark_streaming_job_count{event_type="7"} 1' in out
    assert out.count("# TYPE") == 2 + 8
    done = tmp_path / "live/gauges/progress/task_events/batch_id=0/_SUCCESS"
    deadline = time.time() + 30
    while not done.exists() and time.time() < deadline:
        time.sleep(0.2)
    lines = [r.value for r in spark.read.text(str(done.parent)).collect()]
    assert "# TYPE spark_streaming_task_events_batch_duration gauge" in lines and len(lines) == 8
    by_class = read_counts(spark, f"{tmp_path}/live/counts/task_by_scheduling_class", "scheduling_class", mode="update")
    assert {(r.event_timestamp.timestamp(), r.scheduling_class): r["count"] for r in by_class.collect()} == {
        (1.0, "0"): 1, (2.0, "0"): 1, (3.0, "3"): 1, (4.0, "3"): 1, (5.0, "1"): 1, (6.0, "0"): 1}
    with pytest.raises(ValueError):
        run(spark, arguments(["replay", "--input", source, "--target", f"{tmp_path}/none", "--start-file", "9"]))


def test_convert_and_report_from_the_command_line(spark, source, tmp_path, capsys):
    from run import arguments, run

    run(spark, arguments(["convert", "--input", f"{source}/task_events", "--table", "task_events",
                          "--target", f"{tmp_path}/parquet/task_events", "--files", "2"]))
    run(spark, arguments(["a4", "--input", f"{tmp_path}/parquet", "--output-dir", str(tmp_path), "--format", "parquet"]))
    run(spark, arguments(["report", "--input", f"{tmp_path}/performance"]))
    out = capsys.readouterr().out
    assert "eviction_probability: " in out and "q4_perform" in out


def test_runs_with_the_same_short_name_stay_apart(spark):
    rows = [(f"d/q5_bonus1_performance_metrics_{i}.csv", "q5_bonus1_", m, v)
            for i, (read, process) in enumerate([("10", "500"), ("90", "20")])
            for m, v in (("reading_time", read), ("processing_time", process))]
    timings = spark.createDataFrame(rows, "file STRING, filename STRING, metric STRING, value STRING")
    got = [(r.reading_time, r.processing_time) for r in timing_report(timings).collect()]
    assert got == [("00:00:10", "00:08:20"), ("00:01:30", "00:00:20")]


def test_worker_numbers_and_seconds_are_whole(spark):
    rows = [("d/rdd_q5_1234.csv", "rdd_q5_123", "processing_time", "90061.5")]
    timings = spark.createDataFrame(rows, "file STRING, filename STRING, metric STRING, value STRING")
    row = worker_report(timings).first()
    assert (row.cores, row.processing_seconds, row.label) == (1234, 90061, "1501:01")


def test_variants_from_the_command_line(spark, source, tmp_path, capsys):
    from run import arguments, run

    for name, variant, result in (("a1", "total", "machine_distribution_total"), ("a6", "with-blanks", "job_machine_distribution_with_blanks"),
                                  ("a8", "hit-only", "peaks_evictions_hit_only")):
        run(spark, arguments([name, "--input", source, "--output-dir", str(tmp_path), "--variant", variant]))
        assert f"{result}: " in capsys.readouterr().out
        assert list((tmp_path / "data").glob(f"q*_{result}_*.csv/part-*.csv"))
    with pytest.raises(SystemExit):
        arguments(["a2", "--input", source, "--output-dir", str(tmp_path), "--variant", "total"])


def test_blank_machines_are_none(spark):
    from traceops.operators import keyed, placement

    rows = spark.createDataFrame([("j1", "m1"), ("j1", " "), ("j2", ""), ("j2", "m1"), ("j2", "m2"), ("j3", None), ("j3", "  ")], "job STRING, machine STRING")
    assert [tuple(r) for r in placement.machines_per_job(rows, "job", "machine").orderBy("job").collect()] == [("j1", 1), ("j2", 2)]
    assert [tuple(r) for r in placement.machines_per_job(rows, "job", "machine", drop_unplaced=False).orderBy("job").collect()] == [
        ("j1", 2), ("j2", 3), ("j3", 1)]
    assert {r.machine for r in keyed.hits_per_key(rows, "machine", rows.job == "j1").collect()} == {"m1", "m2"}


@pytest.mark.parametrize("name", list(JOBS))
def test_records_are_counted_by_the_scan_of_the_results(spark, source, tmp_path, name, monkeypatch):
    """No job of its own counts a table, and the counts are those of the tables."""
    from traceops.plans import jobs
    from traceops.sources.trace import read_trace

    want = sum(read_trace(spark, f"{source}/{t}", t).count() for t in JOBS[name].tables)
    saved = {}
    monkeypatch.setattr(jobs.ResultSink, "save_metrics", lambda self, prefix, metrics: saved.update(metrics) or "path")
    monkeypatch.setattr(jobs, "read_trace", lambda *a, **kw: read_trace(*a, **kw).withColumn("_counted", F.lit(1)))
    monkeypatch.setattr(DataFrame, "count", lambda self: pytest.fail("a table is counted"))
    run_job(spark, name, source, str(tmp_path))
    assert saved["total_records"] == want


def test_both_readings_of_the_hour_come_from_one_scan(spark):
    from traceops.operators import hourly

    usage = spark.createDataFrame([(0, 1.0), (3_600_000_000, 3.0), (7_300_000_000, None), (None, 1.0), (-5, 2.0)], "t BIGINT, v DOUBLE")
    both = hourly.hourly_profiles(usage, "t", {"mean": "v"}, keep=lambda sums: sums.persist())
    for unit, df in both.items():
        assert df.collect() == hourly.hourly_profile(usage, "t", {"mean": "v"}, unit).collect()
        assert "InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString()
