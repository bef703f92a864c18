"""Repeated passages: kept where they stand first in the order of document ids, and cut elsewhere, by hashes of sentences.

A unit is a sentence or what is left of a line: it ends behind a line end or behind `.`, `!` or `?` with the blanks that follow. Its
digest is taken of its words (ASCII white space apart), A-Z lowered. A unit is a repeat if a document of a smaller id has
it too, or if it stood in the same document before. Neighbouring repeats are a run, and a run of `run_words` words at
least is cut: single sentences that many texts share stay, however often they occur, as do short lines alone. Documents with the
same id rank alike: they keep what they share with each other. What is cut is listed by its place in the original text
(code points), so the text can be rebuilt from the first copies.

Null text is the empty text and stays null in `text`. Documents with a null id rank last. Repeated rows (same id
and text) get the same result each. An empty table gives no row. Columns of any other name stay as they are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from traceops.llm.storage import checkpointed
from traceops.llm.text import parts, picked, spare, strings

#: words of neighbouring repeats that are cut
RUN_WORDS = 30
#: ends of units
UNIT_END = r"[.!?] +|\n"
#: places that repeated digests are known by in the tasks, a bit each
PLACES = 1 << 27

_UNIT_END = re.compile(UNIT_END)


def units_of(text: str):
    """(start, length, words, digest as two signed longs) of the units with words, in order, with their numbers."""
    start, number = 0, 0
    for end in [m.end() for m in _UNIT_END.finditer(text)] + [len(text)]:
        words = text[start:end].encode().lower().split()
        if words:
            digest = xxhash.xxh3_128_intdigest(b" ".join(words))
            yield number, start, end - start, len(words), (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)
            number += 1
        start = end


def _rank():
    return F.coalesce("key", F.lit((1 << 63) - 1))


def _digests(docs: DataFrame) -> DataFrame:
    """high, low, key of the distinct units of each document, `n` of them in it."""
    schema = pa.schema([("key", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for piece in parts(batch, "text"):
                rows = []
                for key, text in zip(piece.column("key").to_pylist(), strings(piece.column("text")).to_pylist()):
                    seen: dict = {}
                    for _, _, _, _, high, low in units_of(text):
                        seen[high, low] = seen.get((high, low), 0) + 1
                    rows += [(key, high, low, n) for (high, low), n in seen.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4, schema=schema)

    return docs.select("key", "text").mapInArrow(run, "key BIGINT, high BIGINT, low BIGINT, n BIGINT")


def _bitmap(firsts: DataFrame) -> np.ndarray:
    """A bit for the place of each repeated digest: PLACES bits, however many there are."""
    places = firsts.select((F.col("low").bitwiseAND(F.lit(PLACES - 1)) + 1).alias("place"))
    rows = places.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    bits = np.zeros(PLACES // 8, np.uint8)
    for part, held in rows:
        bits[(part - 1) * 4096:part * 4096] = np.frombuffer(bytes(held), np.uint8)
    return bits


def _candidates(docs: DataFrame, bits) -> DataFrame:
    """key, version and the units whose digests may be repeated; `copy` counts those of one document."""
    names = ("number", "start", "length", "words", "high", "low", "copy")
    schema = pa.schema([("key", pa.int64()), ("version", pa.int64()), *((n, pa.int64()) for n in names)])

    def run(batches):
        known = bits.value
        for batch in batches:
            for piece in parts(batch, "text"):
                rows = []
                for key, version, text in zip(piece.column("key").to_pylist(), piece.column("version").to_pylist(),
                                              strings(piece.column("text")).to_pylist()):
                    seen: dict = {}
                    for unit in units_of(text):
                        place = unit[5] & (PLACES - 1)
                        if known[place >> 3] >> (place & 7) & 1:
                            copy = seen[unit[4:]] = seen.get(unit[4:], 0) + 1
                            rows.append((key, version, *unit, copy))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 9, schema=schema)

    return docs.select("key", "version", "text").mapInArrow(run, "key BIGINT, version BIGINT, " + ", ".join(f"{n} BIGINT" for n in names))


def cut_places(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """key, version, removed: the sorted places to cut, for documents with any."""
    # one row for each digest and task goes into this; a digest in a third of the documents is no hot spot
    firsts = checkpointed(_digests(docs).groupBy("high", "low").agg(F.min(_rank()).alias("first"), F.sum("n").alias("n"))
                          .filter("n > 1").select("high", "low", "first"))
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(firsts))
    # the join by digest has no order to keep, so its large partitions are split at run time; repeated rows become one
    repeats = _candidates(docs, sent).join(firsts, ["high", "low"]).filter((F.col("first") < _rank()) | (F.col("copy") > 1))
    own = repeats.groupBy("key", "version").agg(F.sort_array(F.collect_set(F.struct("number", "start", "length", "words"))).alias("units"))
    runs = (own.select("key", "version", F.posexplode("units").alias("place", "unit")).groupBy("key", "version", (F.col("unit.number") - F.col("place")).alias("run"))
            .agg(F.sum("unit.words").alias("words"), F.min("unit.start").alias("start"), F.max(F.col("unit.start") + F.col("unit.length")).alias("end")))
    long = runs.filter(F.col("words") >= run_words)
    return long.groupBy("key", "version").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("length")))).alias("removed"))


def dedup_lines(docs: DataFrame, id_column="doc_id", text_column="text", run_words=RUN_WORDS, removed="removed") -> DataFrame:
    """All columns of `docs` with the text that is left, and in `removed` the places cut from the original text."""
    if removed.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the documents have a column `{removed}` already: give another name for the places")
    own = picked(docs, key=id_column, text=text_column).select(
        F.col("key").cast("bigint").alias("key"), F.xxhash64("text").alias("version"), "text")
    key_name, version = spare(docs, "_key", "_version")
    cut = cut_places(own, run_words).select(F.col("key").alias(key_name), F.col("version").alias(version), F.col("removed").alias(removed))
    text, key = F.col(f"`{text_column}`"), F.col(f"`{id_column}`").cast("bigint")
    joined = docs.join(cut, key.eqNullSafe(F.col(key_name)) & (F.xxhash64(text) == F.col(version)), "left")
    # what lies before, between and behind the places
    places = F.col(removed)
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(places, lambda p: p["start"] + p["length"]))
    ends = F.concat(F.transform(places, lambda p: p["start"]), F.array(F.length(text).cast("bigint")))
    kept = F.array_join(F.zip_with(begins, ends, lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))), "")
    result = F.when(places.isNull(), text).otherwise(kept)
    return joined.select(*[result.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns],
                         F.coalesce(places, F.array().cast("array<struct<start: bigint, length: bigint>>")).alias(removed))
