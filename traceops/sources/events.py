"""JSON events: encoding, and a source that is a broker topic or a folder of files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from traceops.fixed_values import KAFKA_READ, KAFKA_WRITE, MESSAGES, TOPICS
from traceops.functions.casts import whole
from traceops.functions.clock import event_time


def message_schema(kind: str) -> T.StructType:
    return T.StructType.fromDDL(MESSAGES[kind])


def encode_events(rows: DataFrame, kind: str) -> DataFrame:
    """One JSON object per row in column `value`, fields as in the message layout.

    The time is cut to a whole number, all else is text; absent fields are written as null.
    Rows without a time are left out: `split_rejects` tells which.
    """
    fields = [whole(f.name).alias(f.name) if isinstance(f.dataType, T.LongType)
              else F.col(f.name).cast("string").alias(f.name) for f in message_schema(kind)]
    return (rows.filter(whole("timestamp").isNotNull())
            .select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")))


# the message fields that the counts need
_PARSED = "timestamp BIGINT, event_type STRING, scheduling_class STRING, job_id STRING"


def parse_events(messages: DataFrame, unit="s") -> DataFrame:
    """`value` (text or bytes) as `(event_timestamp, event_type, scheduling_class, job_id)`.

    Broken messages and those without a usable time are left out (`broken_events` has them).
    `unit="s"` takes the event time for seconds, `"us"` for microseconds.
    """
    # inline keeps Spark from parsing again for each use of a field
    data = F.from_json(F.col("value").cast("string"), _PARSED)
    return (messages.select(F.inline(F.array(data)))
            .select(event_time("timestamp", unit).alias("event_timestamp"),
                    "event_type", "scheduling_class", "job_id")
            .filter(F.col("event_timestamp").isNotNull()))


def broken_events(messages: DataFrame, unit="s") -> DataFrame:
    text = F.col("value").cast("string")
    time = F.from_json(text, _PARSED)["timestamp"]
    return (messages.select(text.alias("value"), event_time(time, unit).alias("_time"))
            .filter(F.col("_time").isNull()).drop("_time"))


def read_messages(spark: SparkSession, source: str, kind: str, files_per_trigger=1000,
                  **options) -> DataFrame:
    """Stream of messages in column `value`.

    With `kafka.bootstrap.servers` in the options, `source="kafka"` subscribes to the topic of
    `kind` (needs the Kafka connector on the class path); else `source` is a folder of
    JSON-lines files.
    """
    if source == "kafka":
        settings = {"subscribe": TOPICS[kind], **KAFKA_READ, **options}
        return (spark.readStream.format("kafka").options(**settings).load()
                .select(F.col("value").cast("string").alias("value")))
    return (spark.readStream.schema("value STRING").option("maxFilesPerTrigger", files_per_trigger)
            .options(**options).text(source))


def read_events(spark: SparkSession, source: str, kind: str, unit="s", **options) -> DataFrame:
    """Stream of typed events from a topic or a folder."""
    return parse_events(read_messages(spark, source, kind, **options), unit)


def write_events(messages: DataFrame, target: str, kind: str, **options) -> None:
    """Appends messages to the topic of `kind` (`target="kafka"`) or to a folder."""
    if target == "kafka":
        (messages.write.format("kafka").options(**{"topic": TOPICS[kind], **KAFKA_WRITE, **options})
         .save())
    else:
        messages.write.mode("append").options(**options).text(target)
