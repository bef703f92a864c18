"""History as a time-compressed stream."""

import time
import uuid

from pyspark.sql import DataFrame, functions as F

from traceops.functions import as_column
from traceops.functions.casts import whole
from traceops.functions.clock import UNITS
from traceops.sources.events import encode_events, write_events


def replay_schedule(df: DataFrame, ts: str, speed=60, slot_ms=1000, unit="s",
                    per: str | None = None) -> DataFrame:
    """Adds `slot`: the send interval of `slot_ms` an event falls into at `speed`-fold time.

    Time starts at the first event, or with `per` (say, the file) at the first one of each.
    """
    if per is None:
        start, rows = df.agg(F.min(ts)).scalar(), df
    else:
        starts = df.groupBy(F.col(per).alias("_per")).agg(F.min(ts).alias("_start"))
        rows = df.join(starts, F.col(per).eqNullSafe(F.col("_per")))
        start = F.col("_start")
    elapsed = (as_column(ts) - start).cast("double")
    return (rows.withColumn("slot", F.floor(elapsed * 1000 / (UNITS[unit] * speed * slot_ms)))
            .drop("_per", "_start"))


# files of a step, so that many tasks write it
FILES_PER_WAVE = 4


def write_replay(df: DataFrame, kind: str, target: str, speed=60, slot_ms=1000, unit="s",
                 waves=1, **options) -> None:
    """Sends events in order of their send intervals, in `waves` steps, so a stream sees older ones first.

    The rows are read once: they are dealt by range of slot and time and sorted within, so the files (or for a broker the
    tasks) follow each other. Files get times that rise with their order, which is what a file stream goes by. A burst in one slot is
    spread over several files. With one step all is sent at once, in no order.
    """
    ts = F.col("timestamp") if dict(df.dtypes)["timestamp"] == "bigint" else whole("timestamp")
    if waves == 1:
        write_events(encode_events(df, kind), target, kind, **options)
        return
    # the number of the interval from the epoch on rises like that from the first event on, which need not be known
    slot = F.floor(F.col("_time").cast("double") * 1000 / (UNITS[unit] * speed * slot_ms))
    timed = df.withColumn("_time", ts).filter("_time IS NOT NULL").withColumn("_slot", slot)
    ordered = (timed.repartitionByRange(waves * FILES_PER_WAVE, "_slot", "_time", F.xxhash64(*df.columns))
               .sortWithinPartitions("_slot", "_time"))
    if target == "kafka":
        write_events(encode_events(ordered, kind), target, kind, **options)
        return
    spark = df.sparkSession
    draft = f"{target.rstrip('/')}/_draft-{uuid.uuid4().hex}"
    encode_events(ordered, kind).write.options(**options).text(draft)
    _moved_in_order(spark, draft, target)


def _moved_in_order(spark, draft: str, target: str) -> None:
    """Moves the part files of `draft` to `target`, named and timed in their order, after what is there already."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(target)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max((status.getModificationTime() for status in fs.listStatus(folder)
                if not status.getPath().getName().startswith(("_", "."))), default=0)
    parts = sorted((status.getPath().getName() for status in fs.listStatus(path(draft)) if status.getPath().getName().startswith("part-")))
    now = max(last + 1, int(time.time() * 1000) - len(parts))
    for i, name in enumerate(parts):
        # file systems may keep whole seconds only; the order of names then decides among files of one second
        fs.setTimes(path(f"{draft}/{name}"), now + i, -1)
        fs.rename(path(f"{draft}/{name}"), path(f"{target}/{now + i}-{name}"))
    fs.delete(path(draft), True)
