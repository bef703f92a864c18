import gzip
import json

import pytest
from pyspark.sql import functions as F

from traceops.sources import events, sinks, trace


def gz(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def task_files(tmp_path):
    folder = tmp_path / "task_events"
    gz(folder / "part-00000.csv.gz", [
        '100,,j1,0,m1,2,"user, one",0,9,0.5,0.25,0.1',
        '200,,j1,1,,0,u2,1,9,,abc,0.1',
        'bad,,j2,0,m2,2,u2,1,9,0.1,0.1,0.1',
        '300,,j3,0,m3',
    ])
    gz(folder / "part-00001.csv.gz", ['400,,j4,0,m1,2,u,3,0,0.5,0.5,0.5,1'])
    gz(folder / "part-00002.csv.gz", ['5.9e2,,j5,0,m1,2,u,3,0,0.5,0.5,0.5'])
    return str(folder)


def test_reading_under_the_declared_schema(spark, task_files):
    df = trace.read_trace(spark, f"{task_files}/*.csv.gz", "task_events")
    assert dict(df.dtypes)["timestamp"] == "bigint" and len(df.columns) == 12
    rows = {r.job_id: r for r in df.filter("task_index = 0").collect()}
    assert rows["j1"].user == "user, one" and rows["j1"].cpu_request == 0.5
    assert rows["j2"].timestamp is None and rows["j2"].event_type == 2
    assert rows["j3"].event_type is None
    assert rows["j4"].disk_space_request == 0.5  # a field too many
    second = df.filter("task_index = 1").first()
    assert (second.machine_id, second.cpu_request, second.memory_request) == (None, None, None)
    assert trace.row_count(df).first().row_count == 6


def test_filters_reach_the_files(spark, task_files):
    df = trace.read_trace(spark, task_files, "task_events").select("job_id", "scheduling_class")
    plan = df.filter("scheduling_class is not null")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(scheduling_class)]" in plan
    assert "ReadSchema: struct<job_id:string,scheduling_class:int>" in plan


def test_file_slice(spark, task_files):
    names = [n.rsplit("/", 1)[1] for n in trace.file_slice(spark, f"{task_files}/*.gz", 1, 5)]
    assert names == ["part-00001.csv.gz", "part-00002.csv.gz"]
    df = trace.read_trace(spark, f"{task_files}/*.gz", "task_events", start_file=1, num_files=1)
    assert [r.job_id for r in df.collect()] == ["j4"]
    assert trace.read_trace(spark, f"{task_files}/*.gz", "task_events", start_file=9, num_files=1).count() == 0


def test_a_broken_file_can_be_passed_over(spark, task_files, tmp_path):
    (tmp_path / "task_events" / "part-00003.csv.gz").write_bytes(gzip.compress(b"x" * 4000)[:20])
    passed = trace.read_trace(spark, task_files, "task_events", skip_broken_files=True)
    assert passed.filter("job_id = 'j4'").count() == 1
    assert trace.read_text_rows(spark, task_files, "task_events", skip_broken_files=True).filter("job_id = 'j4'").count() == 1
    with pytest.raises(Exception, match="CORRUPT|EOF|FAILED_READ_FILE"):
        trace.read_text_rows(spark, task_files, "task_events").collect()
    with pytest.raises(Exception, match="CORRUPT|EOF|FAILED_READ_FILE"):
        trace.read_trace(spark, task_files, "task_events").collect()


def test_a_broken_file_fails_the_replay(spark, task_files, tmp_path):
    from traceops.plans.streams import replay_files

    (tmp_path / "task_events" / "part-00003.csv.gz").write_bytes(gzip.compress(b"x" * 4000)[:20])
    with pytest.raises(Exception, match="CORRUPT|EOF|FAILED_READ_FILE"):
        replay_files(spark, str(tmp_path), "task", str(tmp_path / "sent"), num_files=9)


def test_states_of_files(spark, tmp_path):
    """Each file against its own end; several parts in a file, no line end, no rows, no gzip at all."""
    whole = b"".join(b"%d,a,b\n" % i for i in range(300_000))
    packed = gzip.compress(whole)
    files = {"a.csv.gz": packed, "b.csv.gz": gzip.compress(b"1\n2") + gzip.compress(b"3\n4"), "c.csv.gz": packed[:-5], "d.csv.gz": packed[:len(packed) // 2],
             "e.csv.gz": packed[:2000] + b"\x00" * 500 + packed[2500:], "f.csv.gz": b"", "g.csv.gz": b"plain text", "h.csv.gz": gzip.compress(b""),
             "i.csv": b"1\n2\n3", "j.csv": b"", "k.csv.gz": packed + b"junk"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    names = [f"file:{tmp_path}/{name}" for name in files]
    assert set(trace.file_slice(spark, str(tmp_path))) <= set(names)
    got = {r.file.rsplit("/", 1)[1]: (r.bytes, r.rows, r.reason) for r in trace.file_states(spark, names).collect()}
    assert {n: b for n, (b, _, _) in got.items()} == {n: len(c) for n, c in files.items()}
    assert [got[n][1:] for n in ("a.csv.gz", "b.csv.gz", "h.csv.gz", "i.csv", "j.csv")] == [(300_000, None), (3, None), (0, None), (3, None), (0, None)]
    assert {n: r for n, (_, _, r) in got.items() if r} == {
        "c.csv.gz": "ends early", "d.csv.gz": "ends early", "e.csv.gz": "damaged", "f.csv.gz": "ends early", "g.csv.gz": "no gzip data", "k.csv.gz": "damaged"}
    assert 100_000 < got["d.csv.gz"][1] < 300_000
    assert trace.file_states(spark, []).count() == 0


def test_a_replay_can_leave_out_broken_files(spark, task_files, tmp_path):
    from run import arguments, run

    broken = tmp_path / "task_events" / "part-00003.csv.gz"
    broken.write_bytes((tmp_path / "task_events" / "part-00000.csv.gz").read_bytes()[:-4])
    for waves in (1, 2):
        run(spark, arguments(["replay", "--input", str(tmp_path), "--target", str(tmp_path / f"sent{waves}"), "--num-files", "9", "--kinds", "task",
                              "--rejects", str(tmp_path / "rejects"), "--waves", str(waves)]))
        assert sorted(json.loads(r.value)["job_id"] for r in spark.read.text(f"{tmp_path}/sent{waves}/task-events").collect()) == ["j1", "j1", "j4", "j5"]
    files = spark.read.option("header", "true").csv(f"{tmp_path}/rejects/task/files")
    assert [(r.file.rsplit("/", 1)[1], r.reason) for r in files.filter("reason IS NOT NULL").collect()] == [("part-00003.csv.gz", "ends early")]
    assert files.count() == 4
    assert sorted(r.job_id for r in spark.read.option("header", "true").csv(f"{tmp_path}/rejects/task/rows").collect()) == ["j2", "j3"]


def test_operators_take_views(spark, task_files):
    from traceops.operators.classes import event_rate_by_class

    trace.read_trace(spark, task_files, "task_events").createOrReplaceTempView("task_events")
    view = spark.sql("SELECT scheduling_class, event_type FROM task_events WHERE timestamp > 0")
    assert [tuple(r) for r in event_rate_by_class(view, "scheduling_class", F.expr("event_type = 2")).collect()] == [
        (0, 1, 1, 1.0), (1, 1, 0, 0.0), (3, 1, 1, 1.0)]


def test_converted_trace_is_the_same(spark, task_files, tmp_path):
    trace.convert_trace(spark, task_files, "task_events", str(tmp_path / "out"), files=2)
    again = trace.read_trace(spark, str(tmp_path / "out"), "task_events", fmt="parquet")
    original = trace.read_trace(spark, task_files, "task_events")
    assert again.exceptAll(original).count() == 0 and original.exceptAll(again).count() == 0


def test_rejects(spark, task_files):
    good, bad = trace.split_rejects(trace.read_text_rows(spark, task_files, "task_events"))
    assert sorted(r.job_id for r in good.collect()) == ["j1", "j1", "j4", "j5"]
    assert sorted(r.job_id for r in bad.collect()) == ["j2", "j3"]


def test_encoding(spark, task_files):
    good, _ = trace.split_rejects(trace.read_text_rows(spark, task_files, "task_events"))
    messages = [json.loads(r.value) for r in events.encode_events(good, "task").collect()]
    first = next(m for m in messages if m["job_id"] == "j1" and m["task_index"] == "0")
    assert first == {"timestamp": 100, "missing_type": "", "job_id": "j1", "task_index": "0", "machine_id": "m1",
                     "event_type": "2", "user": "user, one", "scheduling_class": "0", "priority": "9",
                     "cpu_request": "0.5", "memory_request": "0.25", "disk_space_request": "0.1"}
    assert list(first) == [f.name for f in events.message_schema("task")]
    assert {m["timestamp"] for m in messages} == {100, 200, 400, 590}
    assert next(m for m in messages if m["job_id"] == "j1" and m["task_index"] == "1")["machine_id"] == ""


def test_parsing(spark):
    values = ['{"timestamp": 86400, "event_type": "2", "job_id": "a", "extra": 1}', "no json", '{"event_type": "1"}',
              '{"timestamp": "x", "event_type": "1", "job_id": "b"}', '{"timestamp": 9223372036854775807}']
    messages = spark.createDataFrame([(v.encode(),) for v in values], "value BINARY")
    got = events.parse_events(messages).collect()
    assert [(r.event_type, r.scheduling_class, r.job_id) for r in got] == [("2", None, "a")]
    assert events.parse_events(messages).select(F.unix_seconds("event_timestamp")).first()[0] == 86400
    assert events.parse_events(messages, unit="us").count() == 2
    assert sorted(r.value for r in events.broken_events(messages).collect()) == sorted(values[1:])


def test_messages_to_a_folder(spark, tmp_path):
    messages = spark.createDataFrame([('{"timestamp": 1}',), ('{"timestamp": 2}',)], "value STRING")
    events.write_events(messages, str(tmp_path / "topic"), "job")
    events.write_events(messages, str(tmp_path / "topic"), "job")
    assert spark.read.text(str(tmp_path / "topic")).count() == 4


def test_kafka_needs_its_connector(spark):
    messages = spark.createDataFrame([("x",)], "value STRING")
    with pytest.raises(Exception, match="kafka"):
        events.write_events(messages, "kafka", "job", **{"kafka.bootstrap.servers": "nowhere:1"})
    with pytest.raises(Exception, match="kafka"):
        events.read_events(spark, "kafka", "job", **{"kafka.bootstrap.servers": "nowhere:1"})


def test_result_sink(spark, tmp_path):
    sink = sinks.ResultSink(spark, str(tmp_path), epoch=1700000000)
    path = sink.save(spark.range(3), "q1_x", one_file=True)
    assert path.endswith("/data/q1_x_1700000000.csv")
    assert sorted(r.id for r in spark.read.option("header", True).csv(path).collect()) == ["0", "1", "2"]
    path = sink.save_metrics("q1", {"reading_time": 1.5, "total_records": 7})
    assert path.endswith("/performance/q1_performance_metrics_1700000000.csv")
    rows = [tuple(r) for r in spark.read.option("header", True).csv(path).collect()]
    assert rows == [("reading_time", "1.5"), ("total_records", "7")]
