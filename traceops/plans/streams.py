"""The four running counts as one set of queries, and the replay that feeds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from traceops.sources.events import read_events, read_messages
from traceops.sources.trace import file_slice, file_states, read_text_rows, split_rejects, table_schema
from traceops.streaming import counts, gauges, letters, replay

COUNTS = [(kind, dim) for kind in ("job", "task") for dim in ("event_type", "scheduling_class")]


def _name(kind: str, dim: str) -> str:
    return f"{kind}_by_{dim}"


class Running(dict):
    """The started queries by name; `finish` writes what is left to write when they have ended."""

    def __init__(self, progress: gauges.ProgressBuffer):
        super().__init__()
        self.progress = progress

    def finish(self, spark: SparkSession) -> None:
        self.progress.finish(spark)


def start_all(spark: SparkSession, sources: dict[str, str], output: str, unit="s", mode="update",
              trigger=None, watermark=None, window=None, dead_letters=False, **options) -> Running:
    """Starts jobs and tasks by event type and class; `sources` maps job and task to a source.

    Each query has its own name, checkpoint, count table and gauge files below `output`, so a
    restart with the same `output` goes on where it stopped. The progress of the first query
    of jobs and of tasks is written as gauges too, with the next batch; call `finish` on the result when the queries have ended. With a
    `watermark`, say "1 hour", update mode forgets older event times and events that come later than that are left out; without one, and
    in complete mode, which gives its counts in order of time, the state holds every event time. `mode="append"` needs a watermark and writes each
    time (or `window`) once, when it is closed. `dead_letters` starts a query more for jobs and tasks that sorts messages into
    events and broken ones below `<output>/letters`.
    """
    if mode == "append" and not watermark:
        raise ValueError("append mode needs a watermark that closes times")
    progress = gauges.ProgressBuffer(f"{output}/gauges/progress", {_name(kind, "event_type"): f"{kind}_events" for kind in sources})
    spark.streams.addListener(progress)
    queries = Running(progress)
    for kind, dim in COUNTS:
        name = _name(kind, dim)
        grouped = counts.stream_counts(read_events(spark, sources[kind], kind, unit, **options), dim, watermark=watermark, window=window)
        if mode == "complete":
            grouped = counts.in_time_order(grouped)
        queries[name] = counts.start_counts(
            grouped, f"{output}/counts/{name}", f"{output}/state/{name}", name, mode, trigger,
            also=gauges.GaugeFiles(f"{output}/gauges/{name}", kind, dim, more=progress.drain))
    for kind in sources if dead_letters else ():
        name = f"{kind}_letters"
        queries[name] = letters.start_letters(read_messages(spark, sources[kind], kind, **options), f"{output}/letters/{kind}",
                                              f"{output}/state/{name}", name, kind, unit, trigger)
    return queries


def current_gauges(spark: SparkSession, queries: dict[str, StreamingQuery], output: str,
                   mode="update") -> DataFrame:
    """All gauges as they stand: newest counts of the four queries, progress of the first of each kind."""
    parts = [spark.createDataFrame([], gauges.GAUGES)]
    for kind, dim in COUNTS:
        query = queries[_name(kind, dim)]
        if query.lastProgress is None:
            continue
        table = counts.read_counts(spark, f"{output}/counts/{_name(kind, dim)}", dim, mode=mode)
        parts.append(gauges.count_gauges(table, kind, dim))
        if dim == "event_type":
            parts.append(gauges.progress_gauges(spark, query.lastProgress, f"{kind}_events"))
            if f"{kind}_letters" in queries:
                parts.append(letters.LetterTables(f"{output}/letters/{kind}", kind).gauge(spark))
    return gauges.all_gauges(*parts)


def replay_files(spark: SparkSession, source: str, kind: str, target: str, start_file=0, num_files=1,
                 speed=60, unit="s", waves=1, rejects: str | None = None, **options) -> dict[str, DataFrame]:
    """Sends a slice of the files of `<source>/<kind>_events`; gives the rows sent and rejected.

    A broken file fails the replay, as the rest of it would be neither sent nor rejected. With `rejects`, a folder, files
    that can't be read to their end are left out as a whole and written to `<rejects>/files` with their reason, and rejected rows
    to `<rejects>/rows`.
    """
    table = f"{kind}_events"
    files = file_slice(spark, f"{source.rstrip('/')}/{table}", start_file, num_files)
    if not files:
        raise ValueError(f"no files of {table} from number {start_file} on")
    if rejects:
        states = file_states(spark, files)
        states.write.mode("overwrite").option("header", "true").csv(f"{rejects}/files")
        broken = {r.file for r in spark.read.option("header", "true").csv(f"{rejects}/files", schema=states.schema)
                  .filter("reason IS NOT NULL").select("file").collect()}
        files = [f for f in files if f not in broken]
    rows = read_text_rows(spark, files, table) if files else spark.createDataFrame([], table_schema(table, text=True))
    good, bad = split_rejects(rows)
    replay.write_replay(good, kind, target, speed, unit=unit, waves=waves, **options)
    if rejects:
        bad.write.mode("overwrite").option("header", "true").csv(f"{rejects}/rows")
    return {"sent": good, "rejected": bad}
