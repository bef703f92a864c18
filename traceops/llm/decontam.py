"""Passages of a benchmark in training documents, also edited ones: rare n-gram seeds, then Smith-Waterman.

Words are lower-cased and lose the punctuation around them. The n-grams of the items are counted over all documents; those in none
are left out. Of what is left the rarest in every stretch of `stretch` following n-grams is a seed, and with it every one that occurs `rare` times at most,
so edited copies keep many seeds while frequent n-grams do not bring every document to every item. Seeds are joined
with their places in the documents in Spark; the words around such a place are aligned with the item, and the score
is the best local alignment over that of the whole item with itself. A document that holds an item unchanged scores 1.
Windows that hold too few of the item's words to reach the least score are passed over, which loses no match.

Documents are read once for the places of the items' n-grams, which a bitmap of fixed size tells from others, and again where
there is something to align. A copy without `n` unchanged words in a row is not found, nor is one of which nothing is
left but n-grams that occur more than `rare` times beside rarer ones of the item. An item of fewer than `n` words is found in documents that consist of just
these words, as it says too little inside another text. Null and empty texts match nothing. Documents that repeat an id
give rows of their own, equal rows included; null ids are kept. An empty table or benchmark gives no row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from traceops.llm.storage import checkpointed, freed, small
from traceops.llm.text import parts, picked, spare, strings, words

NGRAM = 3
LEAST_SCORE = 0.5
#: n-grams in a row of which the rarest is a seed, and occurrences up to which all are
STRETCH, RARE = 4, 1000
#: places in the bitmap of the items' n-grams
PLACES = 1 << 24
_EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words around a seed's place that the alignment may reach beyond the item's own length.
SLACK = 8


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As `words`, of lower-cased words without punctuation at their ends; values may repeat or be empty."""
    offsets, codes, values = words(pc.utf8_lower(texts))
    return offsets, codes, pc.replace_substring_regex(values, _EDGES, "")


def grams(texts: pa.Array, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of the n-grams of the texts; a text of fewer words is one n-gram of its own kind."""
    offsets, codes, values = plain_words(texts)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in values.to_pylist()], dtype=np.uint64)
    empty = pc.equal(values, "").to_numpy(zero_copy_only=False)
    kept = ~empty[codes]
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))[kept]
    of_word = hashes[codes][kept]
    offsets = np.searchsorted(text, np.arange(len(texts) + 1))
    total = max(len(of_word) - n + 1, 0)
    code = np.full(total, n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            code = (code ^ of_word[k:k + total]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        at = np.flatnonzero(text[:total] == text[n - 1:n - 1 + total])
        short = np.flatnonzero((np.diff(offsets) > 0) & (np.diff(offsets) < n))
        own = np.array([xxhash.xxh3_64_intdigest(of_word[offsets[i]:offsets[i + 1]].tobytes()) for i in short], dtype=np.uint64)
    return (np.concatenate([text[at], short]), np.concatenate([at - offsets[text[at]], np.zeros(len(short), np.int64)]),
            np.concatenate([code[at], own]).view(np.int64))


def _places(rows: DataFrame, n: int, known=None) -> DataFrame:
    """key, version, place, gram of the texts, with `known` only the n-grams whose bit is set in it."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "version", "place", "gram")])

    def run(batches):
        bits = None if known is None else known.value
        for batch in batches:
            for piece in parts(batch, "text"):
                text, place, gram = grams(strings(piece.column("text")), n)
                if bits is not None:
                    bit = gram & (PLACES - 1)
                    held = (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
                    text, place, gram = text[held], place[held], gram[held]
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([piece.column("key").take(at), piece.column("version").take(at), pa.array(place), pa.array(gram)], schema=schema)

    return rows.select("key", "version", "text").mapInArrow(run, "key BIGINT, version BIGINT, place BIGINT, gram BIGINT")


def _bitmap(owned: DataFrame) -> np.ndarray:
    places = owned.select((F.col("gram").bitwiseAND(F.lit(PLACES - 1)) + 1).alias("place"))
    rows = places.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    bits = np.zeros(PLACES // 8, np.uint8)
    for part, held in rows:
        bits[(part - 1) * 4096:part * 4096] = np.frombuffer(bytes(held), np.uint8)
    return bits


def chosen_seeds(owned: DataFrame, found: DataFrame, stretch: int = STRETCH, rare: int = RARE) -> DataFrame:
    """item, at, gram: which n-grams of the items are seeds, by their occurrences `found` in the documents."""
    often = found.groupBy("gram").agg(F.count("*").alias("often"))
    rows = owned.join(often, "gram")  # what no document has is gone
    order = Window.partitionBy("item", F.floor(F.col("at") / stretch)).orderBy("often", "at")
    return rows.withColumn("nth", F.row_number().over(order)).filter((F.col("nth") == 1) | (F.col("often") <= rare)).select("item", "at", "gram")


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best Smith-Waterman alignment of the item in the window, gaps of linear cost."""
    width = len(window)
    places = np.arange(width + 1)
    row, begin = np.zeros(width + 1, np.int64), places.copy()
    best = (0, 0, 0)
    for token in item:
        step = np.where(window == token, MATCH, MISMATCH)
        now, source = np.zeros(width + 1, np.int64), places.copy()
        across = row[:-1] + step
        down = row[1:] + GAP
        use = across >= down
        now[1:] = np.where(use, across, down)
        source[1:] = np.where(use, begin[:-1], begin[1:])
        source = np.where(now > 0, source, places)
        now = np.maximum(now, 0)
        # gaps along the window: the best earlier cell less its distance
        lifted = now - GAP * places
        reach = np.maximum.accumulate(lifted)
        better = reach + GAP * places > now
        if better.any():
            last = np.maximum.accumulate(np.where(lifted == reach, places, 0))
            now = np.where(better, reach + GAP * places, now)
            source = np.where(better, source[last], source)
        row, begin = now, source
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), int(begin[top]), top)
    return best


def aligned(text: list[int], item: list[int], starts: list[int], least: float) -> tuple[float, int, int] | None:
    """(score, first word, end word) of the best alignment near one of the places where the item may begin; words are numbers."""
    size = len(item)
    reach = size // 2 + SLACK
    starts, best, i = sorted(set(starts)), (0, 0, 0), 0
    while i < len(starts):
        j = i  # seeds whose windows overlap are aligned together
        while j + 1 < len(starts) and starts[j + 1] - starts[j] <= size + 2 * reach:
            j += 1
        a, b = max(starts[i] - reach, 0), min(starts[j] + size + reach, len(text))
        window = text[a:b]
        # no alignment scores more than a match for each of the item's words that the window holds
        if sum(map(set(window).__contains__, item)) >= least * size:
            score, x, y = align(np.array(item), np.array(window))
            if score > best[0]:
                best = (score, a + x, a + y)
        i = j + 1
    score = best[0] / (MATCH * size)
    return (score, best[1], best[2]) if score >= least else None


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where the words of `plain_words` stand in the text, by code points."""
    return [m.span() for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", text) if any(c.isalnum() for c in m[0])]


def word_numbers(texts: pa.Array) -> list[list[int]]:
    """The words of each text as `plain_words` has them, without empty ones, as numbers that are equal for equal words."""
    offsets, codes, values = plain_words(texts)
    numbers = np.array([xxhash.xxh3_64_intdigest(w) >> 1 if w else -1 for w in values.to_pylist()], dtype=np.int64)[codes]
    return [[w for w in part.tolist() if w >= 0] for part in np.split(numbers, offsets[1:-1])] if len(texts) else []


#: bytes of the benchmark's texts up to which tasks get them all at once; a larger one is joined to the documents it may be in
BROADCAST_TEXT = 16 << 20


def _matched(docs: DataFrame, benchmark: DataFrame, item_column: str, item_text_column: str, least: float, n: int, stretch: int, rare: int) -> DataFrame:
    """key, version, item, score, start, end for each row of `docs` (key, version, text); see `find_contamination`."""
    items = picked(benchmark, item=item_column, text=item_text_column).filter("item IS NOT NULL AND text IS NOT NULL")
    # rows that repeat an item id are items of their own
    items = checkpointed(items.select(F.col("item").cast("bigint").alias("item"), F.xxhash64("text").alias("version"), "text").distinct())
    owned = checkpointed(_places(items.withColumnRenamed("item", "key"), n).select(
        F.struct(F.col("key").alias("id"), "version").alias("item"), F.col("place").alias("at"), "gram"))
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(owned))
    found = checkpointed(_places(docs, n, sent).distinct())
    seeds = small(checkpointed(chosen_seeds(owned, found, stretch, rare)))
    pairs = found.join(seeds, "gram").groupBy("key", "version", "item").agg(F.collect_set(F.col("place") - F.col("at")).alias("starts"))
    texts = items.select(F.struct(F.col("item").alias("id"), "version").alias("item"), F.col("text").alias("item_text"))
    few = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] <= BROADCAST_TEXT
    known = {(r.item["id"], r.item["version"]): r.item_text for r in texts.collect()} if few else {}
    known = docs.sparkSession.sparkContext.broadcast(known)
    pairs = pairs.withColumn("item_text", F.lit(None).cast("string")) if few else pairs.join(texts.hint("merge"), "item")
    pairs = checkpointed(pairs.groupBy("key", "version").agg(F.collect_list(
        F.struct(F.col("item.id").alias("id"), F.col("item.version").alias("item_version"), "item_text", "starts")).alias("items")))
    freed(found)
    schema = pa.schema([("key", pa.int64()), ("version", pa.int64()), ("item", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        wanted: dict = {}

        def numbers(item):
            name = item["id"], item["item_version"]
            if name not in wanted:
                if len(wanted) > 100_000:
                    wanted.clear()
                text = item["item_text"]
                wanted[name] = word_numbers(pa.array([known.value[name] if text is None else text], pa.string()))[0]
            return wanted[name]

        for batch in batches:
            for piece in parts(batch, "text"):
                out = []
                texts = strings(piece.column("text"))
                for i, (own, key, version, asked) in enumerate(zip(word_numbers(texts), *(piece.column(c).to_pylist() for c in ("key", "version", "items")))):
                    spans = None
                    for item in asked:
                        best = aligned(own, numbers(item), item["starts"], least)
                        if best:
                            spans = spans or word_spans(texts[i].as_py())
                            out.append((key, version, item["id"], best[0], spans[best[1]][0], spans[best[2] - 1][1]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 6, schema)], schema=schema)

    right = pairs.withColumnsRenamed({"key": "pair_key", "version": "pair_version"})
    # by a shuffle at every size: about every document may have a place to align
    both = docs.join(right.hint("merge"), F.col("key").eqNullSafe(F.col("pair_key")) & (F.col("version") == F.col("pair_version")))
    return both.select("key", "version", "text", "items").mapInArrow(run, "key BIGINT, version BIGINT, item BIGINT, score DOUBLE, start BIGINT, end BIGINT")


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = picked(docs, key=id_column, text=text_column)
    return rows.select(F.col("key").cast("bigint").alias("key"), F.xxhash64("text").alias("version"), "text")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_column="doc_id", text_column="text", item_column="item_id",
                       item_text_column="text", least=LEAST_SCORE, n=NGRAM, stretch=STRETCH, rare=RARE) -> DataFrame:
    """doc_id, item_id, score, start, end of every document and item whose alignment scores `least` or more."""
    rows = _matched(_rows(docs, id_column, text_column), benchmark, item_column, item_text_column, least, n, stretch, rare)
    return rows.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "score", "start", "end")


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column="doc_id", text_column="text", item_column="item_id", item_text_column="text",
                    least=LEAST_SCORE, n=NGRAM, stretch=STRETCH, rare=RARE) -> DataFrame:
    """The rows of `docs`, with all their columns, that match no item."""
    found = _matched(_rows(docs, id_column, text_column), benchmark, item_column, item_text_column, least, n, stretch, rare)
    key, version = spare(docs, "_key", "_version")
    gone = checkpointed(found.select(F.col("key").alias(key), F.col("version").alias(version)).distinct())
    same = F.col(f"`{id_column}`").cast("bigint").eqNullSafe(F.col(key)) & (F.xxhash64(F.col(f"`{text_column}`")) == F.col(version))
    return docs.join(small(gone), same, "left_anti")
