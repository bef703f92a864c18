"""Metric tables `(metric, label_key, label_value, value)` and their text form."""

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from traceops.fixed_values import GAUGE_PREFIX, PROGRESS_GAUGES
from traceops.streaming.counts import latest_counts


GAUGES = "metric STRING, label_key STRING, label_value STRING, value STRING"


def count_gauges(counts: DataFrame, kind: str, dim: str, time_col="event_timestamp") -> DataFrame:
    """Newest count of each label value; `kind` is job or task, `dim` the label."""
    return latest_counts(counts, dim, time_col).select(
        F.lit(f"{GAUGE_PREFIX}{kind}_count").alias("metric"), F.lit(dim).alias("label_key"),
        F.coalesce(F.col(dim).cast("string"), F.lit("None")).alias("label_value"),
        F.col("count").cast("string").alias("value"))


def progress_gauges(spark: SparkSession, progress, name: str) -> DataFrame:
    """Rates, duration and rows of one progress report of a query; four rows, no labels."""
    numbers = (progress["inputRowsPerSecond"], progress["processedRowsPerSecond"],
               progress["durationMs"]["triggerExecution"], progress["numInputRows"])
    rows = [(f"{GAUGE_PREFIX}{name}_{gauge}", None, None, str(number))
            for gauge, number in zip(PROGRESS_GAUGES, numbers)]
    return spark.createDataFrame(rows, GAUGES)


def all_gauges(*parts: DataFrame) -> DataFrame:
    """Several metric tables as one."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def with_label(gauges: DataFrame, label_key: str, pattern=".+") -> DataFrame:
    """Samples whose label `label_key` matches `pattern`."""
    return gauges.filter((F.col("label_key") == label_key) & F.col("label_value").rlike(f"^({pattern})$"))


def to_exposition(gauges: DataFrame) -> DataFrame:
    """Lines of the text format in column `line`: per metric its type, then its samples."""
    label = F.when(F.col("label_key").isNull(), F.lit("")).otherwise(
        F.format_string('{%s="%s"}', "label_key", "label_value"))
    sample = F.concat(F.col("metric"), label, F.lit(" "), F.col("value").cast("string"))
    kind = F.format_string("# TYPE %s gauge", "metric")
    # each sample brings the type line of its metric, of which one stays
    lines = F.array(F.struct(F.lit(0).alias("part"), kind.alias("line")),
                    F.struct(F.lit(1).alias("part"), sample.alias("line")))
    return (gauges.select("metric", F.inline(lines)).distinct()
            .orderBy("metric", "part", "line").select("line"))


def _path(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _batches(spark, folder: str) -> list[int]:
    """Numbers of the batches that have a folder, rising."""
    fs, place = _path(spark, folder)
    if not fs.exists(place):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(place))
    return sorted(int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id="))


def _forget(spark, folder: str, keep: int) -> None:
    """Deletes the folders of all batches but the last `keep`."""
    for number in _batches(spark, folder)[:-keep]:
        fs, place = _path(spark, f"{folder}/batch_id={number}")
        fs.delete(place, True)


class GaugeFiles:
    """Writes the gauges after each batch as text, for `start_counts(also=...)`.

    A batch in update mode has only the counts that changed, so the newest time and count of
    each label are carried from batch to batch in a table with one row per label. Counts of
    one time only grow, hence the greatest (time, count) is the newest. A batch that is run
    again starts from the same table and replaces its own files. The files of the last `keep` batches stay. Where
    the table of the batch before is missing, though this is not the first batch, the query fails unless `fresh` lets it begin anew.

    `more(spark)`, if given, is called after each batch: to write the reports of the batches before, say.
    """

    def __init__(self, folder: str, kind: str, dim: str, time_col="event_timestamp", keep=100, more=None, fresh=False):
        self.folder, self.kind, self.dim, self.time_col = folder, kind, dim, time_col
        self.keep, self.more, self.fresh = keep, more, fresh

    def __call__(self, counts: DataFrame, batch_id: int) -> None:
        spark, newest = counts.sparkSession, f"{self.folder}/newest"
        rows = counts.select(self.dim, self.time_col, "count")
        before = [n for n in _batches(spark, newest) if n < batch_id][-1:]
        if before:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{newest}/batch_id={before[0]}"))
        elif batch_id > 0 and not self.fresh:
            raise ValueError(f"no counts of the batches before {batch_id} in {newest}")
        (rows.groupBy(self.dim).agg(F.max(F.struct(self.time_col, "count")).alias("newest"))
         .select(self.dim, "newest.*").coalesce(1).write.mode("overwrite").parquet(f"{newest}/batch_id={batch_id}"))
        now = spark.read.parquet(f"{newest}/batch_id={batch_id}")
        (to_exposition(count_gauges(now, self.kind, self.dim, self.time_col)).coalesce(1)
         .write.mode("overwrite").text(f"{self.folder}/text/batch_id={batch_id}"))
        for folder in (newest, f"{self.folder}/text"):
            _forget(spark, folder, self.keep)
        if self.more:
            self.more(spark)


class ProgressBuffer(StreamingQueryListener):
    """Keeps the progress reports of the named queries until a batch writes them as text, a folder a batch.

    Spark reports progress in a callback of its own a little after the batch. The callback only notes the last `size` reports; they
    are written by `drain`, which the next batch of a query calls (`GaugeFiles(more=buffer.drain)`), and at
    the end by `finish`, which also takes the listener away. `names` maps query names to gauge names.
    """

    def __init__(self, folder: str, names: dict[str, str], size=1000, keep=100):
        self.folder, self.names, self.keep = folder, names, keep
        self.reports, self.running, self.change = deque(maxlen=size), {}, threading.Condition()

    def onQueryStarted(self, event):
        if event.name in self.names:
            with self.change:
                self.running[event.id] = event.name

    def onQueryProgress(self, event):
        name = self.names.get(event.progress.name)
        if name:
            with self.change:
                self.reports.append((name, event.progress.batchId, event.progress))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.change:
            self.running.pop(event.id, None)
            self.change.notify_all()

    def drain(self, spark: SparkSession) -> None:
        """Writes what was noted since the last time."""
        with self.change:
            noted, self.reports = list(self.reports), deque(maxlen=self.reports.maxlen)
        for name, batch_id, progress in noted:
            (to_exposition(progress_gauges(spark, progress, name)).coalesce(1)
             .write.mode("overwrite").text(f"{self.folder}/{name}/batch_id={batch_id}"))
        for name in {name for name, _, _ in noted}:
            _forget(spark, f"{self.folder}/{name}", self.keep)

    def finish(self, spark: SparkSession, timeout=30) -> None:
        """After the queries have ended: waits for their last reports, writes them and stops listening."""
        with self.change:
            self.change.wait_for(lambda: not self.running, timeout)
        spark.streams.removeListener(self)
        self.drain(spark)
