"""Token ids in files: each document compressed on its own with one shared zstandard dictionary.

A token folder holds two Parquet tables. `dictionary` has one row: its hash and bytes. `blocks` has about a
megabyte of compressed documents in each row, in ascending document order over all shards:

    shard, block          place of the block; shards follow each other in document order
    first_id, last_id     document ids at its ends, so that a reader skips blocks by Parquet statistics
    start                 ids of the shard before this block
    n_ids                 ids in this block
    width                 bytes of an id, little-endian: 2 or 4
    dictionary_hash       SHA-256 of the dictionary that the frames need
    doc_ids, n_tokens     of each document
    offsets               where each document's frame starts in `frames`; its end is the next one's start
    frames                the zstandard frames, one for each document

One document is read by its block's index and one small frame; nothing else is decompressed.

Null text is the empty text and has the end id only. Rows with a null id come first; equal ids follow each other
in the order of their texts' hashes, and repeated rows are kept. An empty table gives empty files.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from traceops.llm.encoder import encoder
from traceops.llm.text import few, parts, picked, strings

#: bytes of text that are encoded at once; a chunk that occurs often in them is looked up once
ENCODE_BYTES = 12 << 20
BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 4096
#: The dictionary is fitted on so many documents, of at most so many characters.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 65_536
DICTIONARY_BYTES = 65_536
LEVEL = 3

BLOCKS = ("shard INT, block INT, first_id BIGINT, last_id BIGINT, start BIGINT, n_ids BIGINT, width INT, "
          "dictionary_hash STRING, doc_ids ARRAY<BIGINT>, n_tokens ARRAY<BIGINT>, offsets ARRAY<BIGINT>, frames BINARY")
READ = "shard INT, key BIGINT, start_in_shard BIGINT, n_tokens BIGINT, width INT, ids BINARY"


def with_end(offsets: np.ndarray, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents with one more id at the end of each."""
    return offsets + np.arange(len(offsets)), np.insert(ids, offsets[1:], end)


def _type(width: int) -> str:
    return "<u2" if width == 2 else "<u4"


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, width: int) -> bytes:
    """A dictionary from a bounded sample, chosen by hash; empty where there is too little to learn from."""
    import zstandard

    chosen = few(docs.filter(F.length("text").between(1, SAMPLE_CHARS)).select(F.xxhash64("key", "text").alias("row")), F.col("row"), SAMPLE_DOCS)
    texts = docs.filter(F.length("text").between(1, SAMPLE_CHARS)).withColumn("row", F.xxhash64("key", "text"))
    # equal rows count once
    rows = texts.join(F.broadcast(chosen.distinct()), "row").groupBy("row").agg(F.first("text").alias("text")).orderBy("row").collect()
    if not rows:
        return b""
    offsets, ids = with_end(*encoder(vocabulary).encode(pa.array([r.text for r in rows])), end_id)
    samples = [x.astype(_type(width)).tobytes() for x in np.split(ids, offsets[1:-1])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b""


def _codec(dictionary: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)


def write_tokens(docs: DataFrame, path: str, id_column="doc_id", text_column="text", *, vocabulary="byte_bpe_50k.json",
                 end_id=2, width=2, partitions=None) -> None:
    """Encodes every whole text and writes the token folder `path`, which all executors must reach.

    `width` 2 is for vocabularies up to 65536 ids.
    """
    docs = picked(docs, key=id_column, text=text_column).withColumn("key", F.col("key").cast("bigint"))
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, vocabulary, end_id, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, dictionary)], "hash STRING, dictionary BINARY").write.parquet(f"{path}/dictionary")

    def pack(batches):
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        compress = _codec(dictionary)[0].compress
        keys, counts, frames, size = [], [], [], 0

        def row():
            offsets = np.cumsum([0] + [len(x) for x in frames])[:-1]
            known = [k for k in keys if k is not None]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                (shard, pa.int32()), (block, pa.int32()), (min(known, default=None), pa.int64()),
                (max(known, default=None), pa.int64()), (start, pa.int64()), (sum(counts), pa.int64()),
                (width, pa.int32()), (digest, pa.string()), (keys, pa.list_(pa.int64())),
                (counts, pa.list_(pa.int64())), (offsets.tolist(), pa.list_(pa.int64())),
                (b"".join(frames), pa.binary()))], schema=_SCHEMA)

        for batch in batches:
            for piece in parts(batch, "text", ENCODE_BYTES):
                offsets, ids = with_end(*encoder(vocabulary).encode(strings(piece.column("text"))), end_id)
                ids = ids.astype(_type(width))
                for key, a, b in zip(piece.column("key").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    frame = compress(ids[a:b].tobytes())
                    if frames and (size + len(frame) > BLOCK_BYTES or len(frames) == BLOCK_DOCS):
                        yield row()
                        start, block = start + sum(counts), block + 1
                        keys, counts, frames, size = [], [], [], 0
                    keys.append(key)
                    counts.append(b - a)
                    frames.append(frame)
                    size += len(frame)
        if frames:
            yield row()

    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key"), F.xxhash64("text")]
    (docs.repartitionByRange(count, *order).sortWithinPartitions(*order)
     .mapInArrow(pack, BLOCKS).write.parquet(f"{path}/blocks"))


_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()),
    ("start", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("dictionary_hash", pa.string()),
    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
    ("frames", pa.binary())])


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row.dictionary).hexdigest() != row.hash:
        raise ValueError(f"the dictionary of {path} is damaged")
    return row.hash, bytes(row.dictionary)


def _unpacker(digest: str, dictionary: bytes, wanted: frozenset | None, finish):
    """Reads blocks; `finish` makes a record batch of (shard, key, start, count, width, ids) columns."""

    def unpack(batches):
        decompress = _codec(dictionary)[1].decompress
        for batch in batches:
            for block in batch.to_pylist():
                if block["dictionary_hash"] != digest:
                    raise ValueError("these frames need another dictionary")
                ends = [*block["offsets"][1:], len(block["frames"])]
                start, frames, out = block["start"], block["frames"], []
                for key, count, a, b in zip(block["doc_ids"], block["n_tokens"], block["offsets"], ends):
                    if wanted is None or key in wanted:
                        raw = decompress(frames[a:b])
                        if len(raw) != count * block["width"]:
                            raise ValueError(f"document {key} is damaged")
                        out.append((block["shard"], key, start, count, block["width"], raw))
                    start += count
                if out:
                    yield finish(*zip(*out))

    return unpack


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """Documents of a token folder: shard, key, start_in_shard, n_tokens, width, ids as bytes.

    With `ids`, only blocks that may hold one of them are read and only their frames are decompressed.
    """
    digest, dictionary = _dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    wanted = None
    if ids is not None:
        wanted = frozenset(ids)
        inside = F.lit(False)
        for i in sorted(wanted):
            inside = inside | ((F.col("first_id") <= i) & (F.col("last_id") >= i))
        blocks = blocks.filter(inside)
    schema = pa.schema([("shard", pa.int32()), ("key", pa.int64()), ("start_in_shard", pa.int64()),
                        ("n_tokens", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])

    def finish(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return blocks.mapInArrow(_unpacker(digest, dictionary, wanted, finish), READ)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, base: ids of all shards before it. One row for each shard, from the index columns only."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    rows, base, out = blocks.collect(), 0, []  # as many numbers as files were written
    for row in sorted(rows):
        out.append((row.shard, base))
        base += row.n
    return spark.createDataFrame(out, "shard INT, base BIGINT")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from what the files hold."""
    digest, dictionary = _dictionary(spark, path)
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def finish(shards, keys, starts, counts, widths, ids):
        crcs = [zlib.crc32(np.frombuffer(x, _type(w)).astype("<u4")) for x, w in zip(ids, widths)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((shards, keys, starts, counts, crcs), schema)],
                                          schema=schema)

    docs = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(
        _unpacker(digest, dictionary, None, finish),
        "shard INT, doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    # the table of shards has one row for each file
    return (docs.join(F.broadcast(shard_starts(spark, path)), "shard")
            .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"))
