"""Session and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app="traceops", master=None, shuffle_partitions=None, **conf) -> SparkSession:
    """A UTC session with adaptive execution; ANSI mode stays on.

    On a cluster adaptive execution starts from many shuffle partitions and merges them to
    about 128 MB each, so the width follows the data. It merges but does not split: for a
    shuffle beyond 2 TB give `shuffle_partitions`, its size divided by 256 MB. Scans use
    splits of 512 MB, as a few columns of that are little to hold.
    """
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # stream state larger than the heap of an executor
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master is None or not master.startswith("local"):
        options["spark.sql.files.maxPartitionBytes"] = "512m"
        if not shuffle_partitions:
            options["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "8192"
    options.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, written below the shared folder and read from there; the files go when the session ends.

    For rows that a plan uses several times and must not find different, and for tables whose real size should decide a join.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder in `spark.checkpoint.dir`.

    Only a local session without that setting gets a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="traceops-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
