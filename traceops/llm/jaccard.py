"""Groups of documents whose sets of word shingles have a Jaccard similarity of at least 0.8.

Filters by prefixes under several global orders of the shingles, each safe, so no link is lost:

1. Order of hashes, over all documents. Of its first shingles under this order (a prefix longer by l than the
   plain prefix filter's), a document with a partner shares at least l with others. One pass counts this from
   compact blocks of hashes; documents with equal sets count once. Few documents are left.
2. Order of rarity, among these. Shingles of a plain prefix that two documents share make candidates.
3. Orders of rising and falling hashes: candidates also share a shingle of both prefixes, else they are dropped
   before their sets are compared. Before that, candidates are dropped whose parity bitmaps (a bit for each
   remainder of the hashes, turned by each shingle) differ in more places than the sets of a link may.

Large groups are not expanded into pairs. Every document is first compared with two pivots of each of its prefix
shingles; components of these links are formed; then pairs are only made across different components, after a
few more pivot rounds. So each pair of documents that shares a prefix shingle is either compared, ruled
out by its bitmaps or already connected.

Null, empty and blank texts have no shingles and are linked with nothing; so are rows with a null id, which have a
null component. Rows that repeat an id are documents of their own. An empty table gives no row. Sets are compared
by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from traceops.llm.components import components
from traceops.llm.storage import BROADCAST_ROWS, checkpointed, freed, released, sized, small
from traceops.llm.text import parts, picked, spare, strings, words

WORDS = 5
#: Rounds of pivots that may follow the first; they save comparisons and change no result.
PIVOT_ROUNDS = 2
#: Longs of a parity bitmap.
BITMAP = 16
#: Shingles that one task of the first filter holds.
TASK_SHINGLES = 2_000_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; a shorter text is one shingle."""
    offsets, codes, values = words(texts, lower=True)
    of_word = np.array([xxhash.xxh3_64_intdigest(w) for w in values.to_pylist()], dtype=np.uint64)[codes]
    total = len(of_word)
    with np.errstate(over="ignore"):
        full = np.zeros(total, np.uint64)
        for k in range(size):
            full *= _ODD[2]
            full[:max(total - k, 0)] += _mixed(of_word[k:] + np.uint64(2 * k + 1))
        full = _mixed(full + np.uint64(size))
        out = []
        ends = offsets.tolist()
        for a, b in zip(ends, ends[1:]):
            if b - a >= size:
                out.append(np.unique(full[a:b - size + 1]))
            elif b > a:
                one = np.zeros(1, np.uint64)
                for k in range(b - a):
                    one = one * _ODD[2] + _mixed(of_word[a + k:a + k + 1] + np.uint64(2 * k + 1))
                out.append(_mixed(one + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def least_shared(n):
    """How many of n shingles a partner at 0.8 has at least."""
    return -(-4 * n // 5)


def prefix_size(n):
    return n - least_shared(n) + 1


def longer_prefix(n):
    """(shingles in the longer prefix, how many of them any partner shares at least)."""
    extra = np.maximum(n // 5, 1)
    smallest = least_shared(n)
    return np.minimum(n - least_shared(n) + extra, n), np.maximum(np.minimum(smallest // 5, extra), 1)


def set_key(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def first_filter(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows of two kinds: (doc_id, n, uid) of each document; (uid, n, shared) in parts to be summed."""

    def spread_out(batches):
        schema = pa.schema([("range", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("hashes", pa.binary())])
        turn = TaskContext.get().partitionId()  # else the first pieces of all tasks come together in one group
        for batch in batches:
            for piece in parts(batch, "text"):
                sets = shingle_sets(strings(piece.column("text")))
                keys, null = piece.column("key"), piece.column("key").is_null().to_numpy(zero_copy_only=False)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                uid = np.array([set_key(s) for s in sets], dtype=np.int64)
                rows = [(ranges + turn % ranges, np.stack([keys.fill_null(0).to_numpy(), null.astype(np.int64), uid, n], axis=1), None, None)]
                turn += 1
                # equal sets once
                kept = np.flatnonzero((n > 0) & ~null)
                kept = kept[np.unique(uid[kept], return_index=True)[1]]
                size = longer_prefix(n[kept])[0]
                hashes = np.concatenate([np.zeros(0, np.uint64), *[sets[i][:p] for i, p in zip(kept, size)]])
                owner = np.repeat(np.arange(len(kept)), size)
                order = np.argsort(hashes, kind="stable")
                hashes, owner = hashes[order], owner[order]
                begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
                count = np.diff(np.append(begin, len(hashes)))
                # shared within the piece: known here; such a hash goes out once, without its documents
                here = np.bincount(owner[np.repeat(count > 1, count)], minlength=len(kept))
                rows.append((ranges + turn % ranges, np.stack([uid[kept], n[kept], here], axis=1), b"", None))
                several, alone = hashes[begin[count > 1]], begin[count == 1]
                hashes, owner = hashes[alone], owner[alone]
                at = (hashes % np.uint64(ranges)).astype(np.int64)
                order = np.lexsort((owner, at))
                hashes, owner, at = hashes[order], owner[order], at[order]
                of = (several % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(of, kind="stable")
                several, of = several[order], of[order]
                # only the ranges that the piece has: their number does not grow with the input
                present = np.union1d(at, of)
                for r, a, b, c, d in zip(present, *(np.searchsorted(x, present, side) for x in (at, of) for side in ("left", "right"))):
                    who, sizes = np.unique(owner[a:b], return_counts=True)
                    # the hashes known to be shared stand first, under no document
                    rows.append((r, uid[kept][who], np.append(d - c, sizes).astype(np.int32), np.concatenate([several[c:d], hashes[a:b]])))
                raw = [[x if x is None or isinstance(x, bytes) else x.tobytes() for x in column] for column in list(zip(*rows))[1:]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array(c, pa.binary()) for c in raw]], schema=schema)

    out = pa.schema([("key", pa.int64()), ("uid", pa.int64()), ("n", pa.int64()), ("shared", pa.int64())])

    def count(table: pa.Table) -> pa.Table:
        results, hashes, owners = [], [], []
        for keys, sizes, raw in zip(*(table.column(c).to_pylist() for c in ("keys", "sizes", "hashes"))):
            if sizes is None:
                key, null, uid, n = np.frombuffer(keys, np.int64).reshape(-1, 4).T
                results.append(pa.Table.from_arrays([pa.array(key, mask=null > 0), pa.array(uid), pa.array(n), pa.array(np.full(len(n), -1))], schema=out))
            elif raw is None:
                uid, n, here = np.frombuffer(keys, np.int64).reshape(-1, 3).T
                results.append(_sums(uid, n, here, out))
            else:
                size = np.frombuffer(sizes, np.int32)
                hashes.append(np.frombuffer(raw, np.uint64))
                # document -1 stands for several
                owners.append(np.repeat(np.append(np.int64(0), np.frombuffer(keys, np.int64)), size))
                owners[-1] = np.stack([owners[-1], np.arange(len(owners[-1])) < size[0]])
        if hashes:
            hashes, (owner, many) = np.concatenate(hashes), np.concatenate(owners, axis=1)
            order = np.lexsort((owner, hashes))
            hashes, owner, many = hashes[order], owner[order], many[order].astype(bool)
            first = np.append(True, hashes[1:] != hashes[:-1])
            group = np.cumsum(first) - 1
            new = first | np.append(True, owner[1:] != owner[:-1]) | many
            weight = np.bincount(group, weights=np.where(many, 2, new))
            hit = new & ~many & (weight[group] >= 2)
            uid, n = np.unique(owner[hit], return_counts=True)
            results.append(_sums(uid, np.zeros(len(uid), np.int64), n, out))
        return pa.concat_tables(results)

    blocks = docs.mapInArrow(spread_out, "range INT, keys BINARY, sizes BINARY, hashes BINARY")
    return blocks.groupBy("range").applyInArrow(count, "key BIGINT, uid BIGINT, n BIGINT, shared BIGINT")


def _sums(uid, n, shared, schema) -> pa.Table:
    return pa.Table.from_arrays([pa.nulls(len(uid), pa.int64()), pa.array(uid), pa.array(n), pa.array(shared.astype(np.int64))], schema=schema)


def hashed_sets(docs: DataFrame) -> DataFrame:
    """uid, n, hashes, bits of the documents; hashes as signed numbers in unsigned order."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("uid", pa.int64()), ("n", pa.int64()), ("hashes", longs), ("bits", longs)])

    def run(batches):
        for batch in batches:
            for piece in parts(batch, "text"):
                sets = shingle_sets(strings(piece.column("text")))
                ends = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                bits = [parity(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array(np.diff(ends).astype(np.int64)),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(bits, longs)], schema=schema)

    return docs.select("text").mapInArrow(run, "uid BIGINT, n BIGINT, hashes ARRAY<BIGINT>, bits ARRAY<BIGINT>")


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bit for each remainder of the hashes: whether an odd number of them has it."""
    odd = np.bincount((hashes % np.uint64(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def near(one: str = "bits", two: str = "bits_b", n_one: str = "n", n_two: str = "n_b"):
    """Whether sizes and bitmaps allow a link: at 0.8, sets differ in a ninth of the sum of their sizes at most."""
    differ = sum((F.bit_count(F.get(one, F.lit(i)).bitwiseXOR(F.get(two, F.lit(i)))) for i in range(BITMAP)), F.lit(0))
    return (9 * differ <= F.col(n_one) + F.col(n_two)) & F.expr(f"5 * least({n_one}, {n_two}) >= 4 * greatest({n_one}, {n_two})")


def prefixes(sets: DataFrame) -> DataFrame:
    """uid, n, shared: of each set the shared shingles in its prefix as (hash, early), rarest first.

    `early` ones are in the shorter prefix that is enough for the smaller set of a pair.
    """
    rows = sets.select("uid", "n", F.explode("hashes").alias("hash"))
    often = rows.groupBy("hash").agg(F.count("*").alias("often")).filter("often > 1")
    shared = rows.join(often, "hash").groupBy("uid").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "hash"))).alias("shared"))  # one set's own
    # shingles of one set alone come first in the order and take places of the prefix
    left = F.expr("n - ((4 * n + 4) DIV 5) + 1 - (n - size(shared))")
    early = F.expr("transform(slice(shared, 1, cast(left AS INT)), (s, i) -> struct(s.hash, n - size(shared) + i < n - ((8 * n + 8) DIV 9) + 1 AS early))")
    return shared.withColumn("left", left).filter("left > 0").select("uid", "n", early.alias("shared"))


def ended(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with columns of both sets, those of b under the name and `_b`. Pairs are counted, so give a checkpointed table.

    Few pairs go to the sets of a, which are not shuffled then, and of the sets of b only those in a pair are. Many are joined by shuffles.
    """
    one = sets.select(F.col("uid").alias("a"), *columns)
    two = sets.select(F.col("uid").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    if pairs.count() <= BROADCAST_ROWS:
        both = one.join(F.broadcast(pairs), "a")
        two = two.join(F.broadcast(pairs.select("b")), "b", "left_semi")
    else:
        paired = small(pairs.select("a").union(pairs.select("b")).distinct())
        both = pairs.hint("merge").join(one.join(paired, "a", "left_semi"), "a")
        two = two.join(paired.withColumnRenamed("a", "b"), "b", "left_semi")
    return both.hint("merge").join(two, "b")


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that pass the prefixes of both hash orders and whose similarity is 0.8 or more, as a checkpointed table."""
    pairs = checkpointed(pairs.select("a", "b").distinct())
    released(pairs.sparkSession)
    return _compared(pairs, sets)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`links` of distinct pairs in a checkpointed table, which goes."""
    both = ended(pairs, sets, "n", "hashes")

    def size(n):
        return F.expr(f"cast({n} - ((4 * {n} + 4) DIV 5) + 1 as int)")

    rising = F.arrays_overlap(F.slice("hashes", F.lit(1), size("n")), F.slice("hashes_b", F.lit(1), size("n_b")))
    falling = F.arrays_overlap(F.slice("hashes", -size("n"), size("n")), F.slice("hashes_b", -size("n_b"), size("n_b")))
    same = F.size(F.array_intersect("hashes", "hashes_b"))
    found = checkpointed(both.filter(rising & falling).filter(100 * same >= 80 * (F.col("n") + F.col("n_b") - same)).select("a", "b"))
    freed(pairs)
    return found


def linked_sets(sets: DataFrame) -> DataFrame:
    """uid, component of the sets that are linked with another."""
    rarest = checkpointed(prefixes(sets))
    released(sets.sparkSession)
    posted = rarest.select("uid", F.inline("shared")).select("hash", "uid", F.col("uid").alias("c"))
    ends = posted.groupBy("hash").agg(F.min("uid").alias("low"), F.max("uid").alias("high")).filter("low != high")
    found = _pivoted(posted.join(ends.withColumns({"least": F.col("low"), "most": F.col("high")}), "hash"), sets)
    labels = components(found)
    n_posted = rarest.agg(F.coalesce(F.sum(F.size("shared")), F.lit(0))).first()[0]
    owned = None
    for turn in range(PIVOT_ROUNDS + 1):
        named = small(labels.withColumnRenamed("node", "uid"))
        # labels come to the sets, and with them to their shingles; those within one component stay so
        held = rarest if owned is None else owned.groupBy("uid").agg(F.first("n").alias("n"), F.collect_list(F.struct("hash", "early")).alias("shared"))
        now = held.join(named, "uid", "left").select("uid", "n", F.coalesce("component", "uid").alias("c"), F.inline("shared"))
        # with one set of the first and of the last component, any, as pivots of another round
        mixed = now.groupBy("hash").agg(F.min("c").alias("least"), F.max("c").alias("most"), F.min_by("uid", "c").alias("low"),
                                        F.max_by("uid", "c").alias("high"), F.count("*").alias("k")).filter("least != most")
        now = checkpointed(now.join(mixed, "hash"))
        freed(rarest if owned is None else owned)
        owned = now
        if turn == PIVOT_ROUNDS:
            break
        # pairs across components, counted without making them
        counts = owned.groupBy("hash", "c").agg(F.count("*").alias("own"), F.first("k").alias("k"))
        across = counts.agg(F.coalesce(F.sum(F.col("own") * (F.col("k") - F.col("own")) / 2), F.lit(0))).first()[0]
        if across <= n_posted:
            break
        more = _pivoted(owned, sets)
        if not more.limit(1).count():
            break
        found = found.union(more)
        freed(labels)
        labels = components(found)
    bits = sets.select("uid", "bits")
    held = owned.select("hash", "uid", "n", "early", "c").join(bits, "uid")
    one = held.select("hash", F.col("uid").alias("a"), "n", "bits", F.col("c").alias("ca"))
    two = held.filter("early").select("hash", F.col("uid").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"), F.col("c").alias("cb"))
    pairs = one.join(two, (one.hash == two.hash) & F.expr("ca != cb AND (n_b < n OR n_b = n AND b < a)") & near())
    last = links(pairs, sets)
    freed(owned)
    if last.limit(1).count():
        labels = components(found.union(last))
    return labels.select(F.col("node").alias("uid"), "component")


def _pivoted(posted: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of sets with the pivots `low` and `high` of their shingles, of components `least` and `most`, if in another."""
    both = F.array(F.struct(F.col("low").alias("b"), F.col("least").alias("cb")), F.struct(F.col("high").alias("b"), F.col("most").alias("cb")))
    pairs = posted.select(F.col("uid").alias("a"), "c", F.inline(both)).filter("c != cb")
    pairs = checkpointed(pairs.select("a", "b").distinct())
    # bitmaps are fetched for pairs and not carried by shingles
    allowed = checkpointed(ended(pairs, sets, "n", "bits").filter(near()).select("a", "b"))
    freed(pairs)
    return _compared(allowed, sets)


def jaccard_components(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """doc_id, n_shingles, component_id, uid, component of every document.

    `uid` is a number of its set of shingles, `component` one of its component: where rows repeat an id, two components
    may have the same smallest id.
    """
    docs = picked(docs, key=id_column, text=text_column).withColumn("key", F.col("key").cast("bigint"))
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    ranges = int(chars // 10 // TASK_SHINGLES) + 32
    rows = checkpointed(first_filter(docs, ranges))
    released(docs.sparkSession)
    every = rows.filter("shared = -1").select("key", "uid", "n")
    of_set = rows.groupBy("uid").agg(F.min(F.expr("if(shared = -1 AND n > 0, key, null)")).alias("first_key"),
                                     F.max(F.expr("if(shared >= 0, n, null)")).alias("n"), F.sum(F.expr("if(shared >= 0, shared, null)")).alias("shared"))
    need = F.expr("greatest(least(((4 * n + 4) DIV 5) DIV 5, greatest(n DIV 5, 1)), 1)")
    kept = checkpointed(of_set.filter((F.col("shared") >= need) & F.col("first_key").isNotNull()).select("uid", "first_key"))
    n_kept = kept.count()
    wanted = sized(kept.select(F.col("first_key").alias("key")), n_kept)
    sets = hashed_sets(docs.join(wanted, "key", "left_semi")).join(sized(kept.select("uid"), n_kept), "uid", "left_semi")
    sets = checkpointed(sets.dropDuplicates(["uid"]))
    released(docs.sparkSession)
    labels = linked_sets(sets)
    freed(sets)
    # the smallest id of each component, then of each set in one
    own = every.filter("key IS NOT NULL AND n > 0").groupBy("uid").agg(F.min("key").alias("first_key"))
    n_labels = labels.count()
    groups = kept.join(sized(labels, n_labels), "uid")
    tops = groups.groupBy("component").agg(F.min("first_key").alias("component_id"))
    named = labels.join(sized(tops, n_labels), "component").select("uid", "component_id", "component")
    named = checkpointed(own.join(sized(named, n_labels), "uid", "left").select(
        "uid", F.coalesce("component_id", "first_key").alias("component_id"), F.coalesce("component", "uid").alias("component")))
    freed(kept)
    # a set may belong to a third of the documents; such a join is split at run time
    out = every.join(named, "uid", "left").select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id")).alias("component_id"), "uid", "component")
    return out


def one_of_each(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """The rows of `docs` with one of each component: the smallest id; of rows with that id, the smallest text hash.

    Rows with a null id and rows without words stay. All columns stay as they are, whatever their names.
    """
    key, version, uid, component_id, component, words_in, place = spare(docs, "_key", "_version", "_uid", "_component_id", "_component", "_words", "_place")
    own = docs.withColumns({version: F.xxhash64(F.col(f"`{text_column}`")), key: F.col(f"`{id_column}`").cast("bigint")})
    found = checkpointed(jaccard_components(docs, id_column, text_column))
    gone = checkpointed(found.filter("doc_id != component_id").select(F.col("doc_id").alias(key)).distinct())
    # an id that stands in several rows is settled row by row
    twice = checkpointed(found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("doc_id IS NOT NULL AND n > 1").select(F.col("doc_id").alias(key)))
    columns = [f"`{c}`" for c in docs.columns]
    if not twice.limit(1).count():
        return own.join(small(gone), key, "left_anti").select(*columns)
    once = own.join(small(gone.union(twice).distinct()), key, "left_anti")
    several = checkpointed(own.join(small(twice), key, "left_semi"))
    sets = hashed_keys(several, text_column, uid)
    named = found.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias(key), F.col("uid").alias(uid), F.col("component_id").alias(component_id),
                                                      F.col("component").alias(component), F.col("n_shingles").alias(words_in)).distinct()
    rows = sets.join(named, [key, uid]).filter(F.col(key) == F.col(component_id))
    wordless = F.when(F.col(words_in) == 0, F.struct(key, version))  # components of their own
    best = Window.partitionBy(component, wordless).orderBy(version, uid)
    rows = rows.withColumn(place, F.row_number().over(best)).filter(F.col(place) == 1)
    return once.select(*columns).union(rows.select(*columns))


def hashed_keys(docs: DataFrame, text_column: str, uid: str) -> DataFrame:
    """All columns and the key of the set of shingles as `uid`."""

    def run(batches):
        for batch in batches:
            for piece in parts(batch, text_column):
                keys = pa.array([set_key(s) for s in shingle_sets(strings(piece.column(text_column)))], pa.int64())
                yield pa.RecordBatch.from_arrays([*piece.columns, keys], names=[*piece.schema.names, uid])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(uid, LongType())]))
