"""Tables in the shared folder, which every executor reads and which outlive any of them."""

from __future__ import annotations

import gc
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from traceops.session import scratch_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one of the cluster; it goes when the session ends."""
    path = scratch_dir(spark, name)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def checkpointed(df: DataFrame, *by: str, codec: str = "snappy") -> DataFrame:
    """The rows from a table in the shared folder: lineage is cut, and plans see the table's real size.

    `by` names columns that it is divided by, so a filter on them reads only its part.
    """
    path = shared_folder(df.sparkSession, "table")
    (df.write.partitionBy(*by) if by else df.write).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(*tables: DataFrame) -> None:
    """Deletes checkpointed tables. Only for those that nothing still to be run reads, their copies in lost executors' place included."""
    spark = tables[0].sparkSession
    for folder in {found[0] for table in tables for found in (re.match(r".*/table-[0-9a-f]{32}(?=/)", name) for name in table.inputFiles()) if found}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    released(spark)


def released(spark: SparkSession) -> None:
    """Deletes the shuffle files of queries that are done: they go once nothing in the driver refers to their plan, so look for such plans now."""
    gc.collect()
    spark._jvm.System.gc()


#: Tables of so many rows of a few numbers are broadcast, some ten megabytes; longer ones are shuffled.
BROADCAST_ROWS = 300_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it has few rows. It is counted, so give a checkpointed one."""
    return sized(df, df.count(), rows)


def sized(df: DataFrame, count: int, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`small` of a table with a known number of rows, or with that many at most."""
    return F.broadcast(df) if count <= rows else df.hint("merge")
