"""URL lists by a cascade of Bloom filters: exact for every key of the corpus, and no join on the pages.

Keys are a host or one of its parent domains, followed by the start of a path. The key universe is every such key
of the corpus whose path is as long as one of the rules'. Level 0 holds the listed keys; the keys of the universe
that pass it by mistake make level 1; listed keys that pass level 1 by mistake make level 2, and so on until no
mistake is left. A key is judged by the first level that it does not pass. The filters are as large as the list
asks for (about log2 of universe over list, in bits a key) and are literals in the plan; their bits are set by an
aggregate, so neither the universe nor the mistakes are ever collected.

Null urls and urls without `://` have an empty host and path and no rule. Repeated rows give repeated rows, an
empty table no row; with an empty list, every url gets the default verdict.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from traceops.llm.storage import checkpointed
from traceops.llm.text import picked

#: Beyond so many listed keys the list is judged in parts, so that a filter in the plan stays small.
LIST_PART = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys of a url, longest first; of equal ones, the longer host first."""
    labels = F.split(host, r"\.")
    domains = F.when(host != "", F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))).otherwise(F.array().cast("array<string>"))
    found = F.flatten(F.transform(domains, lambda d: F.filter(F.array(*[
        F.when(F.length(path) >= n, F.struct((F.length(d) + n).alias("size"), F.length(d).alias("host"),
                                             F.concat(d, F.substring(path, 1, n)).alias("key")))
        for n in lengths]), lambda k: k.isNotNull())))
    return F.transform(F.sort_array(found, asc=False), lambda k: k.key)


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    held: bytes


@dataclass(frozen=True)
class Cascade:
    """Filters in order; even levels hold listed keys, odd ones keys that are not listed."""

    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether the key is listed; exact for keys of the universe."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            verdict = F.when(_passes(key, i, self.levels[i]), verdict).otherwise(F.lit(i % 2 == 1))
        return verdict


def _places(key: Column, number: int, bits: int, hashes: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(number), F.lit(j), key), F.lit(bits).cast("bigint")) for j in range(hashes)])


def _passes(key: Column, number: int, level: Level) -> Column:
    held = F.expr(f"X'{level.held.hex()}'")

    def bit(place):
        byte = F.conv(F.hex(F.substring(held, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (place % 8).cast("int")) == 1

    return F.forall(_places(key, number, level.bits, level.hashes), bit)


def _encode(keys: DataFrame, number: int, count: int, bits_per_key: float) -> Level:
    """A filter over the keys; only its own bytes come to the driver."""
    bits = max(64, math.ceil(count * bits_per_key))
    hashes = max(1, round(bits_per_key * math.log(2)))
    places = keys.select(F.explode(_places(F.col("key"), number, bits, hashes)).alias("place"))
    rows = (places.groupBy(F.floor(F.col("place") / 8).alias("byte"))
            .agg(F.bit_or(F.expr("shiftleft(1, cast(place % 8 as int))")).alias("value")).collect())
    held = bytearray((bits + 7) // 8)
    for row in rows:
        held[row.byte] = row.value
    return Level(bits, hashes, bytes(held))


def build_cascade(universe: DataFrame, listed: list[str], size: int) -> Cascade:
    """`universe` has one column, key, of distinct keys, and `size` rows."""
    if not listed:
        return Cascade(())
    spark = universe.sparkSession
    own = spark.createDataFrame([(k,) for k in listed], "key STRING")
    others = universe.join(F.broadcast(own), "key", "left_anti")  # at most LIST_PART keys
    rate = min(0.5, len(listed) * math.sqrt(2) / max(size, 1))
    levels, sides, counts = [], [own, others], [len(listed), size]
    bits = 1 / math.log(2) * -math.log2(rate)
    while counts[0]:
        number = len(levels)
        levels.append(_encode(sides[0], number, counts[0], max(bits, 1.45)))
        wrong = checkpointed(sides[1].filter(_passes(F.col("key"), number, levels[-1])))
        sides, counts, bits = [wrong, sides[0]], [wrong.count(), counts[0]], 1.45
    return Cascade(tuple(levels))


def filter_urls(pages: DataFrame, allow: list[tuple[str, str]], block: list[tuple[str, str]], id_column="page_id",
                url_column="url", default="allow") -> DataFrame:
    """page_id, host, path, rule, verdict by the longest rule that fits.

    A rule is (host, path): it fits that host and all its subdomains where the url's path starts with the rule's.
    """
    allowed, blocked = sorted({h + p for h, p in allow}), sorted({h + p for h, p in block})
    if both := set(allowed) & set(blocked):
        raise ValueError(f"allowed and blocked: {sorted(both)}")
    lengths = sorted({len(p) for _, p in [*allow, *block]}, reverse=True)
    urls = picked(pages, key=id_column, url=url_column)
    urls = urls.select(F.col("key").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not lengths:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = keys_of(F.col("host"), F.col("path"), lengths)
    universe = checkpointed(urls.select(F.explode(keys).alias("key")).distinct())
    size = universe.count()

    def cascades(listed):
        return [build_cascade(universe, listed[i:i + LIST_PART], size) for i in range(0, len(listed), LIST_PART)]

    def member(key, found):
        hit = F.lit(False)
        for cascade in found:
            hit = hit | cascade.holds(key)
        return hit

    allows, blocks = cascades(allowed), cascades(blocked)
    urls = urls.withColumn("rule", F.get(F.filter(keys, lambda k: member(k, allows) | member(k, blocks)), F.lit(0)))
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(member(F.col("rule"), allows), "allow").otherwise("block")
    return urls.withColumn("verdict", verdict)
