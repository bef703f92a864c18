"""A table that a stream writes batch by batch, with few files however many batches there were.

Each batch is a segment of its own, a folder `batch_id=N` in the table. A manifest names the segments that count, in order; it is a small
file that takes its name in one step, so readers see the table before a batch or after it. Whenever `fan` segments of one level
have come together they are merged into one of the next level, so there are less than `fan` of each level, and a row is written again
once for each level. Folders that a manifest has left out are deleted with the one after it, for readers that hold the former.

A batch that runs again, as after a failure, overwrites its folder if no manifest has it and is passed over if one does.
"""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

#: segments of one level that are merged, files of a batch, and rows of a file of a merged segment
FAN, BATCH_FILES, FILE_ROWS = 16, 8, 5_000_000


class Segments:
    """`mode` says what a batch is: "append" new rows, "update" newer counts of their keys, "complete" the whole table.

    In update mode the newest `count` of the other columns' values holds.
    """

    def __init__(self, path: str, mode="append", fan=FAN):
        self.path, self.mode, self.fan = path.rstrip("/"), mode, fan

    # --- the manifest: files <path>-manifest/<batch>.json, the last one holds ------------------------

    def _at(self, spark, path):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()), place

    def _manifests(self, spark) -> list[str]:
        fs, folder = self._at(spark, f"{self.path}-manifest")
        if not fs.exists(folder):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(folder))
        return sorted(name for name in names if name.endswith(".json") and name[0].isdigit())

    def manifest(self, spark: SparkSession) -> dict | None:
        """`batch`, the last one written, and `segments` with level, path, rows and the last batch of each."""
        names = self._manifests(spark)
        if not names:
            return None
        fs, place = self._at(spark, f"{self.path}-manifest/{names[-1]}")
        stream = fs.open(place)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, spark, content: dict) -> None:
        name = f"{self.path}-manifest/{content['batch']:020d}.json"
        fs, place = self._at(spark, name)
        _, draft = self._at(spark, f"{self.path}-manifest/_{content['batch']}")
        out = fs.create(draft, True)
        out.write(json.dumps(content).encode())
        out.close()
        if not fs.rename(draft, place):
            raise OSError(f"{name} exists already: another query writes this table")
        for old in self._manifests(spark)[:-2]:
            fs.delete(self._at(spark, f"{self.path}-manifest/{old}")[1], False)

    # --- writing -------------------------------------------------------------------------------------

    def write(self, batch: DataFrame, batch_id: int, also=None) -> None:
        """Adds a batch; `also(rows, batch_id)` gets its written rows before it counts."""
        spark = batch.sparkSession
        before = self.manifest(spark) or {"batch": -1, "segments": [], "left": []}
        if batch_id <= before["batch"]:
            return
        path = f"{self.path}/batch_id={batch_id}"
        # the rows of a complete batch may be in order
        (batch if self.mode == "complete" else batch.repartition(BATCH_FILES)).write.mode("overwrite").parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        if also:
            also(rows, batch_id)
        new = {"level": 0, "path": path, "rows": rows.count(), "batch": batch_id}
        if self.mode == "complete":
            kept, left = [new], [s["path"] for s in before["segments"]]
        else:
            kept, left = self._merged(spark, batch.schema, [*before["segments"], new])
        self._commit(spark, {"batch": batch_id, "segments": kept, "left": left, "schema": batch.schema.json()})
        for old in before["left"]:
            fs, place = self._at(spark, old)
            fs.delete(place, True)

    def _merged(self, spark, schema, segments):
        left = []
        while len(segments) >= self.fan and len({s["level"] for s in segments[-self.fan:]}) == 1:
            segments, last = segments[:-self.fan], segments[-self.fan:]
            level, rows = last[0]["level"] + 1, sum(s["rows"] for s in last)
            path = f"{self.path}-merged/{level}-{last[-1]['batch']}"
            (self._rows(spark, schema, last).repartition(max(1, -(-rows // FILE_ROWS)))
             .write.mode("overwrite").parquet(path))
            rows = spark.read.schema(schema).parquet(path).count()
            segments = [*segments, {"level": level, "path": path, "rows": rows, "batch": last[-1]["batch"]}]
            left += [s["path"] for s in last]
        return segments, left

    # --- reading -------------------------------------------------------------------------------------

    def _rows(self, spark, schema, segments) -> DataFrame:
        if not segments:
            return spark.createDataFrame([], schema)
        parts = [spark.read.schema(schema).parquet(s["path"]).withColumn("_batch", F.lit(s["batch"])) for s in segments]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if self.mode != "update":
            return rows.drop("_batch")
        keys = [c for c in schema.names if c != "count"]
        return rows.groupBy(*keys).agg(F.max_by("count", "_batch").alias("count")).select(*schema.names)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows as they stand after the last written batch."""
        from pyspark.sql.types import StructType

        now = self.manifest(spark)
        if now is None:
            raise ValueError(f"nothing was written to {self.path} yet")
        return self._rows(spark, StructType.fromJson(json.loads(now["schema"])), now["segments"])

    def row_count(self, spark: SparkSession) -> int:
        """Rows of all segments, without reading them; in update mode a key may be in several."""
        return sum(s["rows"] for s in (self.manifest(spark) or {"segments": []})["segments"])
