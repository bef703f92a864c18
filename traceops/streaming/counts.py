"""Running counts by event time and one dimension, and where their results go."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from traceops.fixed_values import TRIGGER
from traceops.streaming.segments import FAN, Segments


def stream_counts(events: DataFrame, dim: str, time_col="event_timestamp", watermark=None, window=None) -> DataFrame:
    """Events per event time and value of `dim`, as `count`; works on a batch table too.

    Without a watermark the state keeps every event time for good, and late events always
    count. With one, say "1 hour", older times are dropped from the state and append mode
    becomes possible: a time is given out once, when no more events of it can come. `window`, say "10 minutes", counts
    by windows of that length, under their first moment.
    """
    if watermark:
        events = events.withWatermark(time_col, watermark)
    if not window:
        return events.groupBy(time_col, dim).count()
    return (events.groupBy(F.window(time_col, window).alias("_window"), dim).count()
            .select(F.col("_window.start").alias(time_col), dim, "count"))


def in_time_order(counts: DataFrame, time_col="event_timestamp") -> DataFrame:
    """Sorted counts; on a stream for complete mode only."""
    return counts.orderBy(time_col)


def latest_counts(counts: DataFrame, dim: str, time_col="event_timestamp") -> DataFrame:
    """The count at the newest event time of each value of `dim`."""
    return counts.groupBy(dim).agg(F.max_by("count", time_col).alias("count"))


def start_counts(counts: DataFrame, table: str, checkpoint: str, name: str, mode="complete",
                 trigger=None, also=None, fan=FAN) -> StreamingQuery:
    """Starts a query that writes each batch to `table`, passing over it if it is run again.

    `mode="complete"` writes all counts each time, `"update"` only the changed ones, which is what large state needs, and
    `"append"` those of times that a watermark has closed, once. The table is kept in a bounded number of files, see
    `Segments`; read it with `read_counts`. `also(frame, batch_id)` may do more with a batch, as with gauges.
    The default trigger is the processing time of 10 seconds; give `{"availableNow": True}`
    to run through what is there and stop.
    """
    segments = Segments(table, mode, fan)

    def write(batch: DataFrame, batch_id: int) -> None:
        segments.write(batch, batch_id, also)

    return (counts.writeStream.queryName(name).outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": TRIGGER}))
            .foreachBatch(write).start())


def read_counts(spark: SparkSession, table: str, dim: str | None = None, time_col="event_timestamp",
                mode="complete") -> DataFrame:
    """The counts as they stand after the last written batch."""
    return Segments(table, mode).read(spark)


def await_any(spark: SparkSession, timeout=None):
    """Waits until one of the running queries ends; raises what it failed with."""
    return spark.streams.awaitAnyTermination(timeout)
