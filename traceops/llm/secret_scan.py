"""Secrets in texts: all rules in one pass over the bytes.

The rules become one minimal automaton on the driver (`automaton.py`), a table of three megabytes for the rules below, whose
size depends on the rules alone. Tasks scan whole texts with it. The pass gives the end of each leftmost longest match; where it starts is read
backward from there, at most to the match before it, and a match whose last part is too short is dropped after that.

Null and empty texts have no spans. Each row gives a row, so repeated rows and ids repeat; a null id stays. Spans are in code points,
end exclusive, by start and then by the place of the rule in the list. Matches of one rule do not overlap, those of several may.
Texts of any length are scanned whole, a long one in lanes. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from traceops.llm import automaton
from traceops.llm.text import parts, picked, strings


def either_case(word: str) -> str:
    """A pattern for the word with its ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Leftmost longest matches of `head` and `tail`, kept where the tail has `least` characters.

    What the head takes must be clear from its own text, as its longest match from the start on is taken for it.
    """
    kind: str
    head: str
    tail: str
    least: int = 1


_KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?" + either_case("key")

BASE = (
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", "AKIA", "[A-Z0-9]+", 16),
    # a shorter run holds no longer one, so the length can be counted while reading: short runs are in every text
    Rule("hex", "", "[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", "gh[oprsu]_", "[A-Za-z0-9]+", 36),
    Rule("google", "AIza", "[A-Za-z0-9_-]+", 35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]+", 16),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY", "-----"),
    Rule("slack", "xox[abeoprs]-", "[A-Za-z0-9-]+", 10),
    Rule("stripe", "[rs]k_(live|test)_", "[A-Za-z0-9]+", 16),
)

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
#: bytes that are scanned together, a longer text alone
SCAN_BYTES = 8 << 20


class _Finder:
    def __init__(self, rules: Sequence[Rule], scanner: automaton.Scanner):
        self.rules, self.scanner = rules, scanner
        self.back = [automaton.Anchored(r.head + r.tail, backward=True) for r in rules]
        self.heads = [automaton.Anchored(r.head) for r in rules]

    def spans(self, texts: pa.Array) -> pa.Array:
        """The spans of each text."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        places, bits = automaton.ends(self.scanner, data, offsets) if offsets[-1] > offsets[0] else (np.zeros(0, np.int64),) * 2
        # the text of an end: ends lie after the text's first byte
        of = np.searchsorted(offsets, places, side="left") - 1
        counts = np.zeros(len(texts), np.int64)
        kinds, begins, stops = [], [], []
        cuts = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:]):
            i = int(of[a])
            found = self._in_text(data, int(offsets[i]), int(offsets[i + 1]), places[a:b].tolist(), bits[a:b].tolist())
            if not found:
                continue
            # places in bytes to places in code points
            leads = np.cumsum((data[offsets[i]:offsets[i + 1]] & 0xC0) != 0x80)
            point = lambda place: int(leads[place - 1]) if place else 0
            counts[i] = len(found)
            for start, rule, stop in sorted(found):
                kinds.append(self.rules[rule].kind)
                begins.append(point(start))
                stops.append(point(stop))
        values = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(begins, pa.int64()), pa.array(stops, pa.int64())],
                                            fields=list(_ARROW_SPANS.value_type))
        return pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), values).cast(_ARROW_SPANS)

    def _in_text(self, data, begin, stop, places, bits):
        text = data[begin:stop].tobytes()
        before, found = [0] * len(self.rules), []
        for place, ended in zip(places, bits):
            end = place - begin
            for i, rule in enumerate(self.rules):
                if ended >> i & 1:
                    start = self.back[i].reach(text, end, before[i])
                    before[i] = end
                    if end - self.heads[i].reach(text, start, end) >= rule.least:
                        found.append((start, i, end))
        return found


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, spans)`: for each row the kind, start and end of every match, see above."""
    rows = picked(docs, key=key, text=text)
    rules = tuple(rules)
    if not rules or len({r.kind for r in rules}) < len(rules):
        raise ValueError("give rules of different kinds")
    scanner = automaton.scanner(tuple(r.head + r.tail for r in rules))

    def scan(batches):
        finder = _Finder(rules, scanner)
        for batch in batches:
            for part in parts(batch, "text", SCAN_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("key"), finder.spans(strings(part.column("text")))], names=["key", "spans"])

    schema = f"key {rows.schema['key'].dataType.simpleString()}, spans {SPANS}"
    return rows.mapInArrow(scan, schema).withColumnRenamed("key", key)


def joined(spans) -> F.Column:
    """Spans as `kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(found: DataFrame, base: Sequence[Rule] = BASE, key: str = "doc_id") -> DataFrame:
    """Of the rows of `find_secrets`: the number of spans of each base kind, the hash of those, and all spans as text."""
    kinds = [r.kind for r in base]
    of = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    return found.select(key, *(F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds),
                        F.sha2(joined(of(*kinds)).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
