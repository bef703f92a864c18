"""Result tables and timing files of jobs."""

import time

from pyspark.sql import DataFrame, SparkSession


class ResultSink:
    """CSV results below `<root>/data`, timing files below `<root>/performance`.

    Each is a folder `<name>_<epoch>.csv` that Spark writes with a header.
    """

    def __init__(self, spark: SparkSession, root: str, epoch: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.epoch = int(time.time()) if epoch is None else epoch

    def path(self, kind: str, name: str) -> str:
        return f"{self.root}/{kind}/{name}_{self.epoch}.csv"

    def save(self, df: DataFrame, name: str, one_file=False) -> str:
        """Writes a result; `one_file` only for reports of a few rows."""
        target = self.path("data", name)
        out = df.coalesce(1) if one_file else df
        out.write.mode("overwrite").option("header", "true").csv(target)
        return target

    def save_metrics(self, job: str, metrics: dict[str, float]) -> str:
        target = self.path("performance", f"{job}_performance_metrics")
        rows = [(name, repr(value)) for name, value in metrics.items()]
        (self.spark.createDataFrame(rows, "metric STRING, value STRING").coalesce(1)
         .write.mode("overwrite").option("header", "true").csv(target))
        return target
