"""Phrases whose words stand together more often than their parts would have it: collocations by dynamic itemset counting.

The documents lie in shards that are read again and again in a cycle. Words are counted from the first shard on. A phrase
starts to count at the next shard once the phrases without its last and without its first word have both been seen `least` times in what was
read so far, at whatever shard that is, and stops after a whole cycle. So lengths are counted side by side, few phrases
that can't be frequent are counted at all, and every count that is kept covers each shard once: it is exact.

What a task must know of the phrases before is the step at which they came to `least`: a byte array of fixed size, indexed
by a hash of the phrase, broadcast at each step. Phrases of one place share the earlier step. They start sooner than they
need to, still for a whole cycle, so a full array costs time and changes nothing.

Texts are lower-cased (A-Z) and cut into pieces at `. , ; : ! ?` and line ends, pieces into words at blanks and tabs; phrases lie within
a piece. Everything is by language; a null language is `und`, a null text is empty. Repeated rows count each time. An empty table gives
no rows. Ties are broken by the phrase. Other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from traceops.llm.storage import checkpointed, freed
from traceops.llm.text import give_back, picked

SHARDS = 2
#: places in the array of phrases of one length, a byte each
PLACES = 1 << 24
#: words of a task that are counted together, and bytes of a text that are split at once
TASK_WORDS, CHUNK = 3_000_000, 1 << 20
#: bytes of texts whose words are numbered at once
BLOCK = 8 << 20
NEVER = 255

_BREAK = b"\n"  # itself one of the signs
_SIGNS = bytes(ord(_BREAK) if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ROWS = 50_000


def _chunks(data: bytes):
    """A long text in parts, each cut before a blank or break."""
    at = 0
    while len(data) - at > CHUNK:
        ends = [e for e in (data.find(b" ", at + CHUNK), data.find(_BREAK, at + CHUNK)) if e >= 0]
        end = min(ends, default=len(data))
        yield data[at:end]
        at = end
    yield data[at:]


def _mixed(h: np.ndarray, other) -> np.ndarray:
    """One 64-bit hash of two."""
    h = (h ^ (other + np.uint64(0x9E3779B97F4A7C15) + (h << np.uint64(6)) + (h >> np.uint64(2)))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Counter:
    """Counts the phrases of one task that are due at a step."""

    def __init__(self, step: int, shards: int, longest: int, since: list[np.ndarray]):
        self.step, self.shards, self.longest, self.since = step, shards, longest, since
        self._new()

    def _new(self):
        self.texts, self.size = defaultdict(list), 0
        self.raw, self.bytes = defaultdict(list), 0

    def add(self, lang: str, text: bytes):
        for chunk in _chunks(text.translate(_SIGNS)):
            self.size += chunk.count(b" ") + chunk.count(_BREAK) + 1  # words and breaks, nearly
            chunk = chunk.replace(_BREAK, b" \n ")
            self.raw[lang].append(chunk)
            self.bytes += len(chunk)
            if self.bytes >= BLOCK:
                self._number()
        self.raw[lang].append(_BREAK)
        self.size += 1

    def _number(self):
        """Numbers the words of the texts that came since the last time, as dictionary arrays."""
        for lang, raw in self.raw.items():
            data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
            blank = data == 32
            length = np.diff(np.flatnonzero(blank), prepend=-1) - 1
            ends = np.cumsum(length[length > 0])
            words = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(data[~blank])])
            self.texts[lang].append(words.dictionary_encode())
        self.raw, self.bytes = defaultdict(list), 0

    def due(self, start: np.ndarray) -> np.ndarray:
        return (start <= self.step) & (self.step < start + self.shards)

    def flush(self):
        """(lang, size, phrase, count, start, place) of the phrases since the last flush."""
        self._number()
        for lang in list(self.texts):
            texts = pa.chunked_array(self.texts.pop(lang)).unify_dictionaries()
            words = texts.chunk(0).dictionary
            ids = np.concatenate([x.indices.to_numpy() for x in texts.chunks]).astype(np.int64)
            stop = pc.index(words, _BREAK).as_py()
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
            salt = np.array([xxhash.xxh3_64_intdigest(lang.encode())], np.uint64)
            ids = ids[np.append(True, (ids[1:] != stop) | (ids[:-1] != stop))] if len(ids) > 1 else ids
            own = _mixed(hashes, salt)[ids]
            run, start = own, np.zeros(len(ids), np.int64)  # of the phrase that begins at each place
            inside = ids != stop
            for size in range(1, self.longest + 1):
                if size > 1:
                    known = self.since[size - 2][self._places(run)]
                    late = np.maximum(known[:-1], known[1:])
                    inside = inside[:-1] & (ids[size - 1:] != stop) & (late != NEVER)
                    if not inside.any():
                        break
                    start = late.astype(np.int64) + 1
                    run = _mixed(run[:-1], own[size - 1:])
                at = np.flatnonzero(inside & self.due(start))
                yield from self._counted(lang, size, ids, at, start, run, words)
        self._new()
        give_back()

    def _places(self, hashes):
        return (hashes & np.uint64(len(self.since[0]) - 1)).astype(np.int64)

    def _counted(self, lang, size, ids, at, start, run, words):
        if not len(at):
            return
        code = ids[at]
        for more in range(1, size):
            code = code * len(words) + ids[at + more]
            if more < size - 1:
                code = np.unique(code, return_inverse=True)[1].reshape(-1)
        if size == 1:
            every = np.bincount(code)
            place = np.empty(len(every), np.int64)
            place[code] = at
            at, count = place[every > 0], every[every > 0]
        else:
            _, first, count = np.unique(code, return_index=True, return_counts=True)
            at = at[first]
        for a in range(0, len(at), _ROWS):
            part = at[a:a + _ROWS]
            phrase = words.take(pa.array(ids[part]))
            for more in range(1, size):
                phrase = pc.binary_join_element_wise(phrase, words.take(pa.array(ids[part + more])), b" ")
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, size, np.int32)), phrase.cast(pa.string()),
                 pa.array((start[part] << 32) + self._places(run[part])), pa.array(count[a:a + _ROWS].astype(np.int64))],
                names=["lang", "size", "phrase", "known", "count"])


#: `known` is the step from which a phrase counts, above 32 bits of its place
_COUNTED = "lang string, size int, phrase string, known bigint, count bigint"


def _scanned(shard: DataFrame, step: int, shards: int, longest: int, since, task_words: int) -> DataFrame:
    def count(batches):
        counter = _Counter(step, shards, longest, since.value)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            for lang, text in zip(langs, texts):
                counter.add(lang, text.as_py())
                if counter.size >= task_words:
                    yield from counter.flush()
        yield from counter.flush()

    return shard.select("lang", "text").mapInArrow(count, _COUNTED)


def _reached(totals: DataFrame, size: int, least: int, known: np.ndarray, step: int) -> bool:
    """Notes the step in the places of phrases that have come to `least`; whether there is a new one."""
    bits = (totals.filter((F.col("size") == size) & (F.col("count") >= least)).select((F.col("known").bitwiseAND(F.lit((1 << 32) - 1)) + 1).alias("place"))
            .groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
    new = False
    for part, held in bits.collect():  # a part, numbered from 1, stands for 32768 places: PLACES / 32768 rows of 4 KB at most
        at = (part - 1) * 32768 + np.flatnonzero(np.unpackbits(np.frombuffer(bytes(held), np.uint8), bitorder="little"))
        at = at[known[at] == NEVER]
        known[at] = step
        new = new or len(at) > 0
    return new


def count_phrases(docs: DataFrame, least: int = 10, longest: int = 3, text: str = "text", lang: str = "lang",
                  shards: int = SHARDS, places: int = PLACES, task_words: int = TASK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Tables `(lang, size, phrase, count)` of all phrases with `least` occurrences and `(lang, n)` of all words."""
    if longest < 2 or shards * longest + longest >= NEVER:
        raise ValueError("phrases have two words at least, and steps must fit into a byte")
    spark = docs.sparkSession
    rows = picked(docs, text=text, lang=lang).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                                                     F.coalesce("text", F.lit("")).alias("text"))
    parts = checkpointed(rows.withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int")), "shard", codec="zstd")
    since = [np.full(places, NEVER, np.uint8) for _ in range(longest - 1)]
    totals, words, step, last = None, None, 0, shards - 1
    while step <= last:
        sent = spark.sparkContext.broadcast(since)
        seen = _scanned(parts.filter(F.col("shard") == step % shards), step, shards, longest, sent, task_words)
        if totals is not None:
            seen = seen.unionByName(totals)
        # what has had its cycle is final, and goes if it is rare; rare words go after all words have been summed
        needed = (F.col("count") >= least) | (F.shiftright("known", 32) + shards > step + 1)
        written = needed | (F.col("size") == 1) if step == shards - 1 else needed
        # what is known is the same in all rows of a phrase
        merged = checkpointed(seen.groupBy("lang", "size", "phrase", "known").agg(F.sum("count").alias("count")).filter(written), codec="zstd")
        sent.destroy()
        before, totals, seen = totals, None, None
        if before is not None:
            freed(before)
        if step == shards - 1:
            words = checkpointed(merged.filter("size = 1").groupBy("lang").agg(F.sum("count").alias("n")))
        for size in range(1, longest):
            if _reached(merged, size, least, since[size - 1], step):
                last = max(last, step + shards)
        totals = merged.filter(needed)
        step += 1
    freed(parts)
    return totals.filter(F.col("count") >= least).select("lang", "size", "phrase", "count"), words


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, top: int = 2000, covered: int = 50, text: str = "text",
                 lang: str = "lang", **counting) -> DataFrame:
    """`(lang, rank, phrase, a, l, r, n, score)`: the `top` phrases of two to `longest` words of each language.

    `a` is the count of the phrase, `l` and `r` those of its parts at the cut that scores least, `n` all words of the language; the score is
    floor(1000000 * a * a / (l * r)). Phrases inside a longer one that has at least `covered` percent of their occurrences are left out.
    """
    counts, words = count_phrases(docs, least, longest, text, lang, **counting)
    phrases = counts.filter("size > 1").withColumnRenamed("count", "a")
    signs = F.split("phrase", " ")
    joined = lambda first, length: F.array_join(F.slice(signs, first, length), " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": joined(F.lit(1), F.col("k")), "right": joined(F.col("k") + 1, F.col("size") - F.col("k"))})
    part = lambda side, name: counts.select(F.col("lang"), F.col("phrase").alias(side), F.col("count").alias(name))
    exact = "CAST({0} AS DECIMAL(19, 0)) * CAST({1} AS DECIMAL(19, 0))".format
    scored = (cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
              .withColumn("score", F.expr(f"(1000000 * ({exact('a', 'a')})) div ({exact('l', 'r')})")))
    lowest = (scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score"))
    # every phrase inside a longer one, with the most frequent one around it
    inner = phrases.filter("size > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    around = inner.groupBy("lang", joined(F.col("first"), F.col("length")).alias("phrase")).agg(F.max("a").alias("around"))
    kept = lowest.join(around, ["lang", "phrase"], "left").filter(F.col("around").isNull() | (100 * F.col("around") < covered * F.col("a")))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    return best.join(F.broadcast(words) if words.count() <= 10_000 else words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
