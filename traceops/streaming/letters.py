"""Messages that are no events: kept with their reason beside the events they came with."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from traceops.fixed_values import GAUGE_PREFIX, TRIGGER
from traceops.functions.clock import event_time
from traceops.streaming.segments import Segments

_FIELDS = "timestamp BIGINT, event_type STRING, scheduling_class STRING, job_id STRING, _broken STRING"
EVENT = ("event_timestamp", "event_type", "scheduling_class", "job_id")
#: why a message is no event
NOT_JSON, NO_TIME, FAR_TIME = "not JSON", "no time", "time out of range"


def judged(messages: DataFrame, unit="s") -> DataFrame:
    """Each message once with the fields of its event, its text `value`, and the `reason` why it is none, or null."""
    text = F.col("value").cast("string")
    data = F.from_json(text, _FIELDS, {"columnNameOfCorruptRecord": "_broken"})
    # inline keeps Spark from parsing again for each use of a field; an empty message gives no fields at all
    rows = messages.select(text.alias("value"), F.inline_outer(F.array(data)))
    time = event_time("timestamp", unit)
    reason = (F.when(F.col("_broken").isNotNull() | (F.trim("value") == "") | F.col("value").isNull(), NOT_JSON)
              .when(F.col("timestamp").isNull(), NO_TIME).when(time.isNull(), FAR_TIME))
    return rows.select("value", time.alias("event_timestamp"), *EVENT[1:], reason.alias("reason"))


class LetterTables:
    """Writes a batch of messages as two tables, parsed once: `<folder>/events` and `<folder>/broken` (value, reason).

    Both take a batch once, also if it is run again, and stay in few files. After each batch the number of broken messages so far
    is written as a gauge below `<folder>/gauges`.
    """

    def __init__(self, folder: str, kind: str, unit="s"):
        self.folder, self.kind, self.unit = folder.rstrip("/"), kind, unit
        self.events, self.broken = Segments(f"{self.folder}/events"), Segments(f"{self.folder}/broken")

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        rows = judged(messages, self.unit).persist()
        try:
            self.events.write(rows.filter("reason IS NULL").select(*EVENT), batch_id)
            self.broken.write(rows.filter("reason IS NOT NULL").select("value", "reason"), batch_id)
        finally:
            rows.unpersist()
        from traceops.streaming.gauges import to_exposition

        (to_exposition(self.gauge(spark)).coalesce(1).write.mode("overwrite").text(f"{self.folder}/gauges"))

    def gauge(self, spark: SparkSession) -> DataFrame:
        """The number of broken messages so far, from the manifest of their table."""
        from traceops.streaming.gauges import GAUGES

        return spark.createDataFrame([(f"{GAUGE_PREFIX}{self.kind}_broken_messages", None, None, str(self.broken.row_count(spark)))], GAUGES)


def start_letters(messages: DataFrame, folder: str, checkpoint: str, name: str, kind: str, unit="s", trigger=None) -> StreamingQuery:
    """Starts a query that sorts messages into events and broken ones."""
    return (messages.writeStream.queryName(name).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": TRIGGER})).foreachBatch(LetterTables(folder, kind, unit)).start())
