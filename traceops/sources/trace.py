"""Trace tables: headerless gzip CSV, or the same table as parquet."""

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from traceops.fixed_values import TABLES
from traceops.functions.casts import whole


def table_schema(table: str, text=False) -> T.StructType:
    schema = T.StructType.fromDDL(TABLES[table])
    if text:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    return schema


def file_slice(spark: SparkSession, path: str, start_file=0, num_files=None) -> list[str]:
    """Names of the files at `path`, sorted, from `start_file` on; file contents stay unread."""
    names = (spark.read.format("binaryFile").load(path).select("path")
             .orderBy("path").offset(start_file))
    if num_files is not None:
        names = names.limit(num_files)
    return [row.path for row in names.collect()]


def read_trace(spark: SparkSession, path: str, table: str, start_file=0, num_files=None,
               fmt="csv", skip_broken_files=False) -> DataFrame:
    """A trace table under its declared schema; a field that does not parse is null.

    `path` may be a folder or a glob. gzip cannot be split, so a file is one task: convert
    big traces once with `convert_trace` and read them with `fmt="parquet"`. A broken file
    fails the job unless `skip_broken_files` is set.
    """
    paths = [path]
    if start_file or num_files is not None:
        paths = file_slice(spark, path, start_file, num_files)
    schema = table_schema(table)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", skip_broken_files)
    return reader.parquet(*paths) if fmt == "parquet" else reader.csv(paths, mode="PERMISSIVE")


_BEGUN, _NO_GZIP = "ends early", "no gzip data"


def _read_state(content: bytes, packed: bool) -> tuple[int, str | None]:
    """Lines of a file that can be read, and why its end can't be, if so. A file may hold several gzip parts."""
    if not packed:
        return content.count(b"\n") + (content[-1:] not in (b"", b"\n")), None
    lines, last, rest, reason = 0, b"", content, None if content else _BEGUN
    while rest and reason is None:
        part = zlib.decompressobj(31)
        while rest and not part.eof:
            try:
                text = part.decompress(rest, 1 << 20)
            except zlib.error:
                reason = "damaged" if content[:2] == b"\x1f\x8b" else _NO_GZIP
                break
            rest = part.unconsumed_tail or part.unused_data
            lines += text.count(b"\n")
            last = text[-1:] or last
        if reason is None and not part.eof:
            reason = _BEGUN
    return lines + (last not in (b"", b"\n")), reason


def file_states(spark: SparkSession, files: list[str]) -> DataFrame:
    """`(file, bytes, rows, reason)`: each file against its own end, `reason` null where all of it can be read.

    A row for each of `files` (as `file_slice` names them), so one without any row is there too. A task holds one file at a time; gzip files are unpacked in pieces.
    """
    def states(batches):
        for batch in batches:
            for name, size, content in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "content"))):
                rows, reason = _read_state(content, name.endswith(".gz"))
                yield pa.RecordBatch.from_pylist([{"file": name, "bytes": size, "rows": rows, "reason": reason}], schema=schema)

    schema = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("rows", pa.int64()), ("reason", pa.string())])
    if not files:
        return spark.createDataFrame([], "file STRING, bytes BIGINT, rows BIGINT, reason STRING")
    found = (spark.read.format("binaryFile").load(files).select("path", "length", "content")
             .mapInArrow(states, "file STRING, bytes BIGINT, rows BIGINT, reason STRING"))
    # files without a byte are not read at all
    listed = spark.createDataFrame([(f,) for f in files], "file STRING")
    return listed.join(found, "file", "left").select(
        "file", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.when(F.col("bytes").isNull() & F.endswith("file", F.lit(".gz")), _BEGUN).otherwise(F.col("reason")).alias("reason"))


def read_text_rows(spark: SparkSession, path, table: str, skip_broken_files=False) -> DataFrame:
    """The same files with every field as text, for replay: `""` for an empty field.

    In rows with too few fields the absent ones stay null. A broken file fails the job; `file_states` tells which are. With
    `skip_broken_files` the rest of one is passed over without a count.
    """
    fields = table_schema(table, text=True)
    # the raw line is there when the number of fields is not the expected one
    rows = (spark.read.schema(T.StructType([*fields, T.StructField("_line", T.StringType())]))
            .option("columnNameOfCorruptRecord", "_line").option("ignoreCorruptFiles", skip_broken_files)
            .csv(path, mode="PERMISSIVE"))
    commas = F.length(F.regexp_replace("_line", r'"[^"]*"|[^,]', ""))
    whole_row = F.col("_line").isNull() | (commas >= len(fields) - 1)
    return rows.select(*(F.when(whole_row, F.coalesce(c, F.lit(""))).otherwise(F.col(c)).alias(c)
                         for c in fields.names))


def split_rejects(rows: DataFrame, ts="timestamp") -> tuple[DataFrame, DataFrame]:
    """Text rows that can become events, and those that cannot: bad time or absent field."""
    bad = whole(ts).isNull()
    for c in rows.columns:
        bad = bad | F.col(c).isNull()
    return rows.filter(~bad), rows.filter(bad)


def convert_trace(spark: SparkSession, path: str, table: str, target: str, files=None) -> None:
    """Writes a trace table as parquet; `files` spreads it when it came as one big file."""
    rows = read_trace(spark, path, table)
    (rows.repartition(files) if files else rows).write.mode("overwrite").parquet(target)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    """All timing files below `path` as `(file, filename, metric, value)`; `filename` is cut for display."""
    from traceops.functions.text import file_stem

    # a result written by Spark is a folder `<name>.csv` with part files in it
    named = F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "")
    return (spark.read.schema("metric STRING, value STRING").option("header", "true")
            .option("recursiveFileLookup", "true").csv(path)
            .select(named.alias("file"), file_stem(named).alias("filename"), "metric", "value"))
