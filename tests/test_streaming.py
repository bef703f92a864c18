import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from traceops.plans.tables import QUERIES
from traceops.session import scratch_dir
from traceops.sources.events import encode_events, parse_events, read_events, read_messages
from traceops.streaming import counts, gauges, letters, replay, segments

ONCE = {"availableNow": True}


def message(ts, event_type, cls="0", **more):
    return json.dumps({"timestamp": ts, "event_type": event_type, "scheduling_class": cls, "job_id": "j", **more})


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    time.sleep(0.02)  # files are taken in the order of their times


FILES = [
    ("1.json", [message(100, "0"), message(100, "0"), message(160, "2", "3"), "{broken"]),
    ("2.json", [message(100, "0", extra="x"), message(200, "0", "1"), message(160, "2", "3")]),
    ("3.json", [message(50, "2"), message(100, "0"), '{"event_type": "9"}', message(100, "1", "2")]),
]


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    for name, lines in FILES:
        put(folder, name, lines)
    return folder


def as_dict(df, dim):
    return {(r["event_timestamp"].timestamp(), r[dim]): r["count"] for r in df.collect()}


def batch_counts(spark, folder, dim):
    parsed = parse_events(spark.read.schema("value STRING").text(str(folder)))
    return as_dict(counts.stream_counts(parsed, dim), dim)


def start(spark, topic, tmp_path, dim="event_type", mode="complete", kind="job", name="c", **kw):
    stream = read_events(spark, str(topic), kind, files_per_trigger=1)
    grouped = counts.stream_counts(stream, dim, watermark=kw.pop("watermark", None))
    if mode == "complete":
        grouped = counts.in_time_order(grouped)
    query = counts.start_counts(grouped, f"{tmp_path}/{name}/table", f"{tmp_path}/{name}/state", f"{name}_{mode}_{dim}",
                                mode, ONCE, **kw)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("mode", ["complete", "update"])
@pytest.mark.parametrize("dim", ["event_type", "scheduling_class"])
def test_stream_equals_batch(spark, topic, tmp_path, mode, dim):
    query = start(spark, topic, tmp_path, dim, mode)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3  # one batch per file
    table = counts.read_counts(spark, f"{tmp_path}/c/table", dim, mode=mode)
    got = as_dict(table, dim)
    assert got == batch_counts(spark, topic, dim)
    if dim == "event_type":
        assert got[100.0, "0"] == 4 and got[50.0, "2"] == 1 and got[160.0, "2"] == 2


def test_restart_goes_on_from_the_checkpoint(spark, topic, tmp_path):
    start(spark, topic, tmp_path, mode="update")
    put(topic, "4.json", [message(100, "0"), message(300, "5")])
    query = start(spark, topic, tmp_path, mode="update")
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    got = as_dict(counts.read_counts(spark, f"{tmp_path}/c/table", "event_type", mode="update"), "event_type")
    assert got == batch_counts(spark, topic, "event_type") and got[100.0, "0"] == 5


def test_sorted_complete_batches(spark, topic, tmp_path):
    start(spark, topic, tmp_path)
    batch = spark.read.parquet(f"{tmp_path}/c/table/batch_id=2")
    times = [r.event_timestamp for r in batch.collect()]
    assert len(times) == 5 and min(times).timestamp() == 50


def test_watermark_closes_old_times(spark, topic, tmp_path):
    put(topic, "4.json", [message(10_000, "0")])
    put(topic, "5.json", [message(10_001, "0")])
    start(spark, topic, tmp_path, mode="append", watermark="10 minutes")
    got = as_dict(spark.read.parquet(f"{tmp_path}/c/table").drop("batch_id"), "event_type")
    want = batch_counts(spark, topic, "event_type")
    assert got == {k: v for k, v in want.items() if k[0] < 9_000}


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_latest_counts_and_gauges_per_batch(spark, topic, tmp_path, mode):
    """The last file has a late event of type 2: its gauge stays with the newer time."""
    start(spark, topic, tmp_path, mode=mode, also=gauges.GaugeFiles(f"{tmp_path}/gauges", "job", "event_type"))
    table = counts.read_counts(spark, f"{tmp_path}/c/table", "event_type", mode=mode)
    latest = {r.event_type: r["count"] for r in counts.latest_counts(table, "event_type").collect()}
    assert latest == {"0": 1, "1": 1, "2": 2}
    lines = [r.value for r in spark.read.text(f"{tmp_path}/gauges/text/batch_id=2").collect()]
    assert lines == ["# TYPE spark_streaming_job_count gauge", 'spark_streaming_job_count{event_type="0"} 1',
                     'spark_streaming_job_count{event_type="1"} 1', 'spark_streaming_job_count{event_type="2"} 2']
    first = [r.value for r in spark.read.text(f"{tmp_path}/gauges/text/batch_id=0").collect()]
    assert first[1:] == ['spark_streaming_job_count{event_type="0"} 2', 'spark_streaming_job_count{event_type="2"} 1']


def test_gauges_go_on_after_a_restart(spark, topic, tmp_path):
    files = gauges.GaugeFiles(f"{tmp_path}/gauges", "job", "event_type")
    start(spark, topic, tmp_path, mode="update", also=files)
    put(topic, "4.json", [message(200, "0"), message(20, "1")])
    start(spark, topic, tmp_path, mode="update", also=files)
    lines = [r.value for r in spark.read.text(f"{tmp_path}/gauges/text/batch_id=3").collect()]
    assert lines[1:] == ['spark_streaming_job_count{event_type="0"} 2', 'spark_streaming_job_count{event_type="1"} 1',
                         'spark_streaming_job_count{event_type="2"} 2']
    # the same batch once more, as after a failure
    batch = spark.read.parquet(f"{tmp_path}/c/table/batch_id=3")
    files(batch, 3)
    assert [r.value for r in spark.read.text(f"{tmp_path}/gauges/text/batch_id=3").collect()] == lines


def test_gauges_of_several_queries(spark, topic, tmp_path):
    queries = [start(spark, topic, tmp_path, dim, "update", kind, f"{kind}_{dim}")
               for kind in ("job", "task") for dim in ("event_type", "scheduling_class")]
    assert len({q.name for q in queries}) == 4
    parts = [gauges.count_gauges(counts.read_counts(spark, f"{tmp_path}/{kind}_{dim}/table", dim, mode="update"), kind, dim)
             for kind in ("job", "task") for dim in ("event_type", "scheduling_class")]
    progress = [p for p in queries[0].recentProgress if p["numInputRows"]][-1]
    everything = gauges.all_gauges(*parts, gauges.progress_gauges(spark, progress, "job_events"))
    lines = [r.line for r in gauges.to_exposition(everything).collect()]
    assert len([line for line in lines if line.startswith("# TYPE")]) == 6
    assert 'spark_streaming_task_count{scheduling_class="3"} 2' in lines
    assert "spark_streaming_job_events_num_input_rows 4" in lines
    assert any(line.startswith("spark_streaming_job_events_input_rate ") for line in lines)
    assert lines.index("# TYPE spark_streaming_job_count gauge") < lines.index('spark_streaming_job_count{event_type="0"} 1')
    labelled = gauges.with_label(everything, "scheduling_class", "[13]")
    assert {r.label_value for r in labelled.collect()} == {"1", "3"}


def test_null_labels_are_written_as_none(spark):
    one = spark.createDataFrame([(None, 5)], "event_type STRING, count BIGINT").withColumn(
        "event_timestamp", F.timestamp_seconds(F.lit(1)))
    assert gauges.to_exposition(gauges.count_gauges(one, "task", "event_type")).collect()[1].line == (
        'spark_streaming_task_count{event_type="None"} 5')


def test_a_failing_query_is_reported(spark, topic, tmp_path):
    def fail(frame, batch_id):
        raise RuntimeError("sink is full")

    stream = read_events(spark, str(topic), "job")
    query = counts.start_counts(counts.stream_counts(stream, "event_type"), f"{tmp_path}/t", f"{tmp_path}/s", "failing",
                                trigger=ONCE, also=fail)
    with pytest.raises(Exception, match="sink is full"):
        counts.await_any(spark, 60)
        query.awaitTermination()
    spark.streams.resetTerminated()


def test_replay_schedule(spark):
    rows = spark.createDataFrame([("a", 1000), ("a", 1000), ("a", 1059), ("a", 1060), ("b", 5000), ("b", 5120)],
                                 "f STRING, t BIGINT")
    slots = lambda **kw: [r.slot for r in replay.replay_schedule(rows, "t", **kw).orderBy("f", "t").collect()]
    assert slots(speed=60) == [0, 0, 0, 1, 66, 68]
    assert slots(speed=60, per="f") == [0, 0, 0, 1, 0, 2]
    assert slots(speed=60, slot_ms=500) == [0, 0, 1, 2, 133, 137]
    assert slots(speed=60, unit="us") == [0] * 6


def test_replayed_history_counts_like_the_table(spark, tmp_path):
    """Trace rows -> messages sent in order -> stream -> counts, beside counts of the rows."""
    rows = spark.range(500).selectExpr(
        "cast(id * 7 as string) AS timestamp", "'' AS missing_type", "cast(id as string) AS job_id",
        "cast(id % 4 as string) AS event_type", "'u' AS user", "cast(id % 3 as string) AS scheduling_class",
        "'n' AS job_name", "'l' AS logical_job_name").union(
        spark.sql("SELECT 'bad', '', 'x', '0', 'u', '0', 'n', 'l'"))
    target = f"{tmp_path}/topic"
    replay.write_replay(rows, "job", target, speed=600, waves=4)
    stream = read_events(spark, target, "job", files_per_trigger=3)
    query = counts.start_counts(counts.stream_counts(stream, "event_type"), f"{tmp_path}/t", f"{tmp_path}/s",
                                "replayed", "update", ONCE)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 3
    got = counts.read_counts(spark, f"{tmp_path}/t", "event_type", mode="update")
    want = counts.stream_counts(parse_events(encode_events(rows, "job")), "event_type")
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == 500
    replay.write_replay(rows, "job", f"{tmp_path}/at_once", speed=600)
    assert spark.read.text(f"{tmp_path}/at_once").count() == 500


def test_messages_come_unparsed_too(spark, topic):
    assert read_messages(spark, str(topic), "job").isStreaming


def test_scratch_folder_is_the_shared_one(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert scratch_dir(spark, "x").startswith(f"{before.rstrip('/')}/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_a_cluster_has_to_name_its_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster, "x")
    Cluster.sparkContext.master = "local[2]"
    assert "/x-" in scratch_dir(Cluster, "x")


def test_streamed_query_runs_twice(spark):
    sizes = [QUERIES["st7_latest_count"](spark, "/root/testdata/sf0.001").count() for _ in range(2)]
    assert sizes[0] == sizes[1] > 0


def test_registered_streams_run_in_several_batches(spark, monkeypatch):
    from traceops.plans import tables

    started = []
    start_counts = counts.start_counts
    monkeypatch.setattr(counts, "start_counts", lambda *a, **kw: started.append(start_counts(*a, **kw)) or started[-1])
    tables.a11_stream_task_event_type(spark, "/root/testdata/sf0.001").count()
    assert len([p for p in started[0].recentProgress if p["numInputRows"]]) == tables.STREAM_PARTS


def test_runner_forgets_times_behind_the_watermark(spark, topic, tmp_path):
    from run import arguments
    from traceops.plans.streams import start_all

    args = arguments(["stream", "--source", "s", "--output-dir", "o", "--watermark", "10 minutes"])
    put(topic, "4.json", [message(10_000, "0")])
    for late in (None, "5.json"):
        if late:  # behind the watermark, and just inside it
            put(topic, late, [message(100, "0"), message(9_900, "0")])
        queries = start_all(spark, {kind: str(topic) for kind in ("job", "task")}, f"{tmp_path}/live",
                            trigger=ONCE, watermark=args.watermark)
        for query in queries.values():
            query.awaitTermination()
    got = as_dict(counts.read_counts(spark, f"{tmp_path}/live/counts/job_by_event_type", "event_type", mode="update"), "event_type")
    assert got[100.0, "0"] == 4 and got[9_900.0, "0"] == 1 and got[10_000.0, "0"] == 1


# --- tables of few files ------------------------------------------------------------

def batch_rows(spark, number, times=30):
    """Batch `number` counts one time more, and one time again."""
    return spark.createDataFrame([(number % times, "a", number + 1), (number % 7, "b", number + 1)], "t INT, dim STRING, count BIGINT")


def files_of(table):
    return [f for folder in (table, f"{table}-merged", f"{table}-manifest") for f in Path(folder).rglob("*")
            if f.is_file() and f.name.startswith(("part-", "0"))]


@pytest.mark.parametrize("mode", ["append", "update"])
def test_many_batches_stay_in_few_files(spark, tmp_path, monkeypatch, mode):
    monkeypatch.setattr(segments, "BATCH_FILES", 1)
    table = segments.Segments(f"{tmp_path}/t", mode, fan=4)
    most = 0
    for number in range(40):
        table.write(batch_rows(spark, number), number)
        most = max(most, len(files_of(f"{tmp_path}/t")))
    now = table.manifest(spark)
    assert [s["level"] for s in now["segments"]] == [2, 2, 1, 1] and now["batch"] == 39
    # under four segments of a level, those of the manifest before, and two manifests
    assert most <= 3 * 3 + 4 + 4 + 3
    got = sorted(map(tuple, table.read(spark).collect()))
    rows = [tuple(r) for number in range(40) for r in batch_rows(spark, number).collect()]
    if mode == "append":
        assert got == sorted(rows) and table.row_count(spark) == 80
    else:
        newest = {(t, dim): n for t, dim, n in rows}
        assert {(t, dim): n for t, dim, n in got} == newest and len(got) == len(newest)


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    table = segments.Segments(f"{tmp_path}/t", "append", fan=3)

    def fails(rows, number):
        raise RuntimeError("no room")

    with pytest.raises(RuntimeError):
        table.write(batch_rows(spark, 0), 0, fails)
    with pytest.raises(ValueError, match="nothing was written"):
        table.read(spark)
    for number in (0, 0, 1, 2, 2, 1, 3):  # after a failure the last batch comes again, also when it was merged
        table.write(batch_rows(spark, number), number)
    assert table.read(spark).count() == 8
    # a merge that was written and not committed is written again
    (tmp_path / "t-merged" / "1-5").mkdir(parents=True)
    for number in (4, 5):
        table.write(batch_rows(spark, number), number)
    assert table.read(spark).count() == 12
    # a draft of a manifest that was never named does not count
    (tmp_path / "t-manifest" / "_6").write_text("{")
    assert segments.Segments(f"{tmp_path}/t", "append", fan=3).manifest(spark)["batch"] == 5


def test_complete_tables_keep_the_last_batch(spark, tmp_path):
    table = segments.Segments(f"{tmp_path}/t", "complete")
    for number in range(5):
        table.write(batch_rows(spark, number), number)
    assert sorted(map(tuple, table.read(spark).collect())) == sorted(map(tuple, batch_rows(spark, 4).collect()))
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["batch_id=3", "batch_id=4"]


# --- closed times, dead letters, reports, replay -------------------------------------

def test_append_mode_needs_a_watermark_and_gives_windows_once(spark, tmp_path):
    from run import arguments, run

    topics = tmp_path / "topics"
    topics.mkdir()
    for kind in ("job", "task"):
        folder = topics / f"{kind}-events"
        put(folder, "1.json", [message(100, "0"), message(170, "0"), message(400, "1")])
        put(folder, "2.json", [message(5_000, "0"), message(200, "0")])
    stream = ["stream", "--source", str(topics), "--output-dir", f"{tmp_path}/live", "--available-now", "--mode", "append"]
    with pytest.raises(ValueError, match="watermark"):
        run(spark, arguments(stream))
    run(spark, arguments([*stream, "--watermark", "10 minutes", "--window", "5 minutes"]))
    got = as_dict(counts.read_counts(spark, f"{tmp_path}/live/counts/job_by_event_type", mode="append"), "event_type")
    assert got == {(0.0, "0"): 3, (300.0, "1"): 1}
    for kind in ("job", "task"):
        put(topics / f"{kind}-events", "3.json", [message(9_000, "2"), message(100, "0")])
    run(spark, arguments([*stream, "--watermark", "10 minutes", "--window", "5 minutes"]))
    got = counts.read_counts(spark, f"{tmp_path}/live/counts/job_by_event_type", mode="append")
    assert as_dict(got, "event_type") == {(0.0, "0"): 3, (300.0, "1"): 1, (4_800.0, "0"): 1} and got.count() == 3


BROKEN = [("{broken", letters.NOT_JSON), ("", letters.NOT_JSON), ("  ", letters.NOT_JSON), ('{"event_type": "9"}', letters.NO_TIME),
          ('{"timestamp": "soon"}', letters.NOT_JSON), (message(2**63 - 1, "0"), letters.FAR_TIME), ("[1]", letters.NOT_JSON)]


def test_messages_are_judged_like_the_counts_take_them(spark):
    texts = [text for text, _ in BROKEN] + [message(5, "0"), message(6, None), '{"timestamp": 7}', None]
    rows = spark.createDataFrame([(t,) for t in texts], "value STRING")
    got = letters.judged(rows)
    assert [(r.value, r.reason) for r in got.collect()] == BROKEN + [(t, None) for t in texts[7:10]] + [(None, letters.NOT_JSON)]
    assert sorted(map(tuple, got.filter("reason IS NULL").select(*letters.EVENT).collect()), key=str) == sorted(
        map(tuple, parse_events(rows).collect()), key=str)


def test_dead_letters_of_a_stream(spark, tmp_path, capsys):
    from run import arguments, run

    topics = tmp_path / "topics"
    topics.mkdir()
    for kind in ("job", "task"):
        put(topics / f"{kind}-events", "1.json", [message(1, "0"), "{broken", message(2, "1")])
        put(topics / f"{kind}-events", "2.json", [message(3, "0"), '{"event_type": "9"}'])
    stream = ["stream", "--source", str(topics), "--output-dir", f"{tmp_path}/live", "--available-now", "--dead-letters"]
    run(spark, arguments(stream))
    assert "spark_streaming_task_broken_messages 2" in capsys.readouterr().out
    put(topics / "task-events", "3.json", ["{more", message(4, "0")])
    run(spark, arguments(stream))
    tables = letters.LetterTables(f"{tmp_path}/live/letters/task", "task")
    assert sorted(tuple(r) for r in tables.broken.read(spark).collect()) == [
        ('{"event_type": "9"}', letters.NO_TIME), ("{broken", letters.NOT_JSON), ("{more", letters.NOT_JSON)]
    assert sorted(r.event_timestamp.timestamp() for r in tables.events.read(spark).collect()) == [1, 2, 3, 4]
    assert "spark_streaming_task_broken_messages 3" in [r.value for r in spark.read.text(f"{tmp_path}/live/letters/task/gauges").collect()]
    # a batch again, as after a failure between the two tables
    tables(spark.createDataFrame([("{more",), (message(4, "0"),)], "value STRING"), tables.broken.manifest(spark)["batch"])
    assert tables.broken.read(spark).count() == 3 and tables.events.read(spark).count() == 4


def test_reports_are_written_by_the_next_batch_and_at_the_end(spark, topic, tmp_path):
    buffer = gauges.ProgressBuffer(f"{tmp_path}/progress", {"p_update_event_type": "job_events"}, size=3)
    spark.streams.addListener(buffer)
    drained = []

    def drain(session):
        drained.append(len(buffer.reports))
        buffer.drain(session)

    start(spark, topic, tmp_path, mode="update", name="p",
          also=gauges.GaugeFiles(f"{tmp_path}/gauges", "job", "event_type", more=drain))
    buffer.finish(spark)
    assert len(drained) == 3 and not buffer.reports
    done = [p.name for p in (tmp_path / "progress" / "job_events").iterdir()]
    assert "batch_id=2" in done
    lines = [r.value for r in spark.read.text(f"{tmp_path}/progress/job_events/batch_id=2").collect()]
    assert "spark_streaming_job_events_num_input_rows 4" in lines and len(lines) == 8
    start(spark, topic, tmp_path, mode="update", name="q")  # nobody listens any more
    assert not buffer.reports and not buffer.running


def test_gauges_do_not_begin_anew_in_the_middle(spark, topic, tmp_path):
    files = gauges.GaugeFiles(f"{tmp_path}/gauges", "job", "event_type", keep=2)
    rows = counts.stream_counts(parse_events(spark.read.schema("value STRING").text(str(topic))), "event_type")
    with pytest.raises(ValueError, match="before 3"):
        files(rows, 3)
    for number in range(4):
        files(rows, number)
    assert sorted(p.name for p in (tmp_path / "gauges" / "text").iterdir()) == ["batch_id=2", "batch_id=3"]
    gauges.GaugeFiles(f"{tmp_path}/other", "job", "event_type", fresh=True)(rows, 3)


def test_replayed_files_follow_each_other_in_time(spark, tmp_path):
    """One file a batch: no event is older than one of a batch before, with a burst in one slot and files that were there before."""
    rows = spark.range(2000).selectExpr(
        "cast(IF(id % 3 = 0, 5000, (id * 7919) % 10000) as string) AS timestamp", "'' AS missing_type", "cast(id as string) AS job_id",
        "'0' AS event_type", "'u' AS user", "'0' AS scheduling_class", "'n' AS job_name", "'l' AS logical_job_name").repartition(6)
    target = f"{tmp_path}/topic"
    replay.write_replay(rows.filter("timestamp < 100"), "job", target, speed=60)
    replay.write_replay(rows, "job", target, speed=60, waves=3)
    seen = []
    query = (read_events(spark, target, "job", files_per_trigger=1).writeStream.trigger(**ONCE).option("checkpointLocation", f"{tmp_path}/s")
             .foreachBatch(lambda batch, number: seen.append(batch.agg(F.min("event_timestamp"), F.max("event_timestamp"), F.count("*")).first()))
             .start())
    query.awaitTermination()
    seen = [r for r in seen if r[2]]
    replayed, total = [], 0
    for r in reversed(seen):  # the last files are the replay
        if total < 2000:
            replayed.insert(0, r)
            total += r[2]
    assert total == 2000 and len(replayed) >= 8
    assert all(a[1] <= b[0] for a, b in zip(replayed, replayed[1:]))
    assert max(r[2] for r in replayed) < 700
