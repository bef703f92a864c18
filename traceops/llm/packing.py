"""Packing into fixed sequences: shortest pack first, over the histogram of lengths.

A document's ids are cut every `capacity` ids. Whole pieces are sequences of their own; of what is left over,
only the histogram of lengths goes to the driver, at most `capacity` - 1 numbers at any size of the input. There
lengths are placed longest first, each into the shortest open packs, many at once: a pattern with its count. The
patterns come back to the documents by rank: the n-th document of a length takes the n-th place of that length.

Null text is the empty text and has the end id only. Repeated rows are documents of their own, a null id stays
null, and an empty table gives no piece. Which sequence a document goes to depends on how the input is split; the
patterns do not.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from traceops.llm.encoder import ENCODE_BYTES, encoder
from traceops.llm.storage import checkpointed
from traceops.llm.text import parts, picked, spread, strings
from traceops.llm.token_files import with_end

BUCKET_DOCS = 100_000
PIECES = ("key BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, "
          "offset BIGINT")


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths in a pack, number of such packs), by shortest pack first."""
    room: list[tuple[int, int]] = []  # (-free ids, pattern): the shortest pack has most room
    patterns: list[list] = []  # [pattern it grew from, last length, count]

    def grow(parent, length, count, free):
        patterns.append([parent, length, count])
        if count and free:
            heapq.heappush(room, (-free, len(patterns) - 1))
        return len(patterns) - 1

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and room and -room[0][0] >= length:
            free, at = room[0]
            take = min(left, patterns[at][2])
            patterns[at][2] -= take
            left -= take
            if not patterns[at][2]:
                heapq.heappop(room)
            grow(at, length, take, -free - length)
        # a new pack is the shortest one as long as this length fits into it again
        fit = capacity // length
        for number, count in ((fit, left // fit), (left % fit, 1)):
            at = None
            for i in range(number if count else 0):
                at = grow(at, length, count if i == number - 1 else 0, capacity - (i + 1) * length)
    out = []
    for parent, length, count in patterns:
        if count:
            lengths = [length]
            while parent is not None:
                parent, length, _ = patterns[parent]
                lengths.append(length)
            out.append((lengths[::-1], count))
    return out


def places(packs: list[tuple[list[int], int]], first_sequence: int) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset) in order of rank."""
    out: dict[int, list] = {}
    used: dict[int, int] = {}
    for lengths, count in packs:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            out.setdefault(length, []).append((rank, first_sequence, offset))
            used[length] = rank + count
            offset += length
        first_sequence += count
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def encoded(docs: DataFrame, id_column: str, text_column: str, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """key, doc_tokens, crcs: the checksum of each piece of `capacity` ids."""
    schema = pa.schema([("key", pa.int64()), ("doc_tokens", pa.int64()), ("crcs", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for piece in parts(batch, "text", ENCODE_BYTES):
                offsets, ids = with_end(*encoder(vocabulary).encode(strings(piece.column("text"))), end_id)
                raw, ends = ids.astype("<u4").tobytes(), offsets.tolist()
                crcs = [[zlib.crc32(raw[4 * i:4 * min(i + capacity, b)]) for i in range(a, b, capacity)]
                        for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(np.diff(offsets)), pa.array(crcs, schema[2].type)],
                                                 schema=schema)

    docs = picked(docs, key=id_column, text=text_column).withColumn("key", F.col("key").cast("bigint"))
    return docs.mapInArrow(run, "key BIGINT, doc_tokens BIGINT, crcs ARRAY<BIGINT>")


def pack_documents(docs: DataFrame, id_column="doc_id", text_column="text", *, vocabulary="byte_bpe_50k.json",
                   end_id=0, capacity=1024) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = checkpointed(encoded(docs, id_column, text_column, vocabulary, end_id, capacity)
                        .withColumn("row", F.monotonically_increasing_id()))
    rows = rows.withColumns({"rest": F.col("doc_tokens") % capacity, "whole": F.expr(f"doc_tokens DIV {capacity}")})
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("whole"), F.lit(0)).alias("whole")).first()
    histogram = {r.rest: r["count"] for r in rows.filter("rest > 0").groupBy("rest").count().collect()}
    slots = places(pack_histogram(histogram, capacity), total.whole)

    # ranks by two short windows: inside a bucket of rows, and over the buckets
    buckets = max(64, total.n // BUCKET_DOCS)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    inside = rows.repartition("bucket").withColumns({
        "rank": F.row_number().over(Window.partitionBy("bucket", "rest").orderBy("row")) - 1,
        "before": F.sum("whole").over(Window.partitionBy("bucket").orderBy("row")) - F.col("whole")})
    ranks = rows.groupBy("bucket", "rest").agg(F.count("*").alias("_n")).select(
        "bucket", "rest", (F.sum("_n").over(Window.partitionBy("rest").orderBy("bucket")) - F.col("_n")).alias("rank_base"))
    firsts = rows.groupBy("bucket").agg(F.sum("whole").alias("_n"), F.lit(0).alias("_one"))
    firsts = firsts.select("bucket", (F.sum("_n").over(Window.partitionBy("_one").orderBy("bucket")) - F.col("_n")).alias("first"))
    placed = inside.join(ranks, ["bucket", "rest"]).join(firsts, "bucket").select(
        "key", "doc_tokens", "crcs", "whole", "rest", (F.col("rank") + F.col("rank_base")).alias("rank"),
        (F.col("before") + F.col("first")).alias("first"))

    def pieces(batches):
        for batch in batches:
            tokens, whole, rest, rank, first = (batch.column(n).to_numpy(zero_copy_only=False) for n in
                                                ("doc_tokens", "whole", "rest", "rank", "first"))
            crcs = batch.column("crcs")
            count = whole + (rest > 0)
            doc = np.repeat(np.arange(len(tokens)), count)
            number = spread(np.zeros(len(count), np.int64), count)
            last = number == whole[doc]
            length = np.where(last, rest[doc], capacity)
            sequence, offset = first[doc] + number, np.zeros(len(doc), np.int64)
            for size in np.unique(rest[rest > 0]):
                table, at = slots[int(size)], np.flatnonzero(last & (rest[doc] == size))
                slot = np.searchsorted(table[:, 0], rank[doc[at]], side="right") - 1
                sequence[at] = table[slot, 1] + rank[doc[at]] - table[slot, 0]
                offset[at] = table[slot, 2]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(doc)), pa.array(number * capacity), pa.array(length), crcs.flatten(),
                 pa.array(tokens[doc]), pa.array(sequence), pa.array(offset)],
                names=["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(pieces, PIECES).withColumnRenamed("key", "doc_id")
