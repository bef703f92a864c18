"""Repairs the order of roles in conversations by the cheapest edits, which are written down as an audit.

After repair a conversation is empty, or a system message if any and then turns of user and assistant in pairs: its role initials
are `(s?(ua)+)?`. A row is kept (K, costs 0), given the role of user or assistant (R, 3) or deleted (D, 4; blank and duplicate
rows must be); empty user or assistant messages are inserted anywhere (I, 3); a truncated row that is not deleted costs 3 more.
The audit is the initials of the edits in order; of the cheapest ones the least in ASCII order is taken.

The rows come as a sorted stream, so a task never holds the texts of a conversation: a first, narrow stream finds the audit, a
second one applies it. While rows are read there is one best prefix of edits for each state of the roles (none yet, after s, u, a).
Prefixes are linked nodes that share what they have in common (`Edits`); two of equal cost are compared where their letters first
differ, found by jumps along their ancestors and hashes of the prefixes. Of two such prefixes none begins the other: both have a letter
for each row, so the longer would have more inserts and cost more.

Rows are ordered by turn (null first), then role, then SHA-256 of the text. Null roles and texts count as one space. Null keys are a
conversation of their own, repeated rows are duplicates, any other role than s..., u... and a... cannot be kept (a role without a sign
neither). An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from traceops.llm.storage import checkpointed
from traceops.llm.text import picked

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: states of the roles so far: none, after the system message, after a user, after an assistant
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: what a rerole or an insert leads to
MADE = (USER, USER, ASSISTANT, USER)

_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Edits:
    """A prefix of edits: the prefix before it and a letter, with ancestors 1, 2, 4, ... letters back and a rolling hash."""

    __slots__ = ("depth", "hash", "letter", "back", "like")

    def __init__(self, before: Edits | None = None, letter: str = ""):
        self.letter, self.like = letter, None
        if before is None:
            self.depth = self.hash = 0
            self.back = ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(letter)) % _PRIME
        back, level, node = [before], 0, before
        while level < len(node.back):
            node = node.back[level]
            back.append(node)
            level += 1
        self.back = tuple(back)

    def at(self, depth: int) -> Edits:
        """The prefix of so many letters."""
        node, rest = self, self.depth - depth
        while rest:
            level = rest.bit_length() - 1
            node = node.back[level]
            rest -= 1 << level
        return node

    def __str__(self) -> str:
        letters, node = [], self
        while node.depth:
            letters.append(node.letter)
            node = node.back[0]
        return "".join(reversed(letters))


def _first(node: Edits) -> Edits:
    """The node that stands for this one after it was found to be the same text."""
    while node.like is not None:
        node = node.like
    return node


def same(a: Edits, b: Edits) -> bool:
    """Whether two prefixes of one length are the same text. Equal hashes are verified letter by letter, once for a pair."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    pairs = []
    while (a := _first(a)) is not (b := _first(b)):
        if a.letter != b.letter:
            return False
        pairs.append((a, b))
        a, b = a.back[0], b.back[0]
    for a, b in pairs:
        b.like = a
    return True


def less(a: Edits, b: Edits) -> bool:
    """Whether `a` comes before `b` in ASCII order: by the first letter after their longest common prefix."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if same(x, y):
        return a.depth < b.depth
    for level in range(len(x.back) - 1, -1, -1):
        if level < len(x.back) and not same(x.back[level], y.back[level]):
            x, y = x.back[level], y.back[level]
    return x.letter < y.letter


class Audit:
    """The cheapest edits of the rows read so far, one prefix for each state that can be reached."""

    def __init__(self):
        self.best: list[tuple[int, Edits] | None] = [(0, Edits()), None, None, None]

    @staticmethod
    def _offer(best, state: int, cost: int, edits: Edits):
        held = best[state]
        if held is None or cost < held[0] or cost == held[0] and less(edits, held[1]):
            best[state] = (cost, edits)

    def _inserts(self):
        """Empty messages before the next row: first all that lead to a user, then to an assistant. More are never cheaper."""
        best = self.best
        for target, states in ((USER, (NONE, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            for state in states:
                if best[state] is not None:
                    cost, edits = best[state]
                    if best[target] is None or cost + INSERT <= best[target][0]:
                        self._offer(best, target, cost + INSERT, Edits(edits, "I"))

    def read(self, initial: str, must_go: bool, truncated: bool):
        self._inserts()
        after = [None] * 4
        extra = TRUNCATED if truncated else 0
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, edits = held
            self._offer(after, state, cost + DELETE, Edits(edits, "D"))
            if must_go:
                continue
            target = NEXT[state].get(initial)
            if target is not None:
                self._offer(after, target, cost + KEEP + extra, Edits(edits, "K"))
            if target != MADE[state]:
                self._offer(after, MADE[state], cost + REROLE + extra, Edits(edits, "R"))
        self.best = after

    def result(self) -> tuple[int, str]:
        """Cost and letters of the cheapest whole repair."""
        self._inserts()
        end = [self.best[NONE], self.best[ASSISTANT]]
        if end[0] is None or end[1] is not None and (end[1][0] < end[0][0] or end[1][0] == end[0][0] and less(end[1][1], end[0][1])):
            end.reverse()
        return end[0][0], str(end[0][1])


def applied(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired messages; `rows` gives role and text of the messages in order."""
    state, rows = NONE, iter(rows)
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        state = NEXT[state][role[:1]] if edit == "K" else MADE[state]
        yield edit, role if edit == "K" else "user" if state == USER else "assistant", text


_BLANKS = r"[\x20\x09-\x0D]"


def _messages(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """key, turn, role, text and the hash of the text that orders messages of one turn and role."""
    space = F.lit(" ")
    return (picked(rows, key=key, turn=turn, role=role, text=text)
            .withColumns({"turn": F.col("turn").cast("bigint"), "role": F.coalesce("role", space), "text": F.coalesce("text", space)})
            .withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))))


#: keys beyond it are spread by AQE only; the order of the rows of a conversation
_ORDER = ("turn", "role", "digest")


def _faults(messages: DataFrame) -> DataFrame:
    """Each message with its fault: blank, duplicate (of one before it in its conversation), truncated or none.

    The first of alike messages comes from an aggregate and not from a window, so a message that fills a large part of a
    conversation is no burden to one task. Messages alike in turn too are told apart by `_copies`, their number.
    """
    last = F.regexp_extract("text", rf"(?s)([^\x20\x09-\x0D]){_BLANKS}*$", 1)
    own = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    counted = messages.select("key", *_ORDER, own.alias("fault")).groupBy("key", *_ORDER, "fault").agg(F.count("*").alias("_copies"))
    # nulls first: a message without a turn is before those that have one
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (counted.groupBy(F.col("key").alias("_key"), F.col("role").alias("_role"), F.col("digest").alias("_digest"))
             .agg(F.min(place).alias("_first")))
    alike = F.col("key").eqNullSafe(F.col("_key")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    repeated = F.col("_first") != place
    return (counted.join(first, alike).select("key", *_ORDER, "fault", "_copies", repeated.alias("repeated")))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _runs(batches, *columns):
    """Rows of a sorted stream as tuples."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _audited(rows):
    """(key, counts, audit) of each conversation of a sorted stream of (key, turn, role, fault, repeated, copies)."""
    held = None
    for key, turn, role, fault, repeated, copies in rows:
        if held is None or held["key"] != key:
            if held is not None:
                yield held
            held = {"key": key, **dict.fromkeys(_COUNTS, 0), "audit": Audit(), "turns": 0, "first": None, "last": None, "initial": None}
        if turn is not None and turn != held["last"]:
            held["turns"] += 1
            held["first"] = turn if held["first"] is None else held["first"]
            held["last"] = turn
        for copy in range(copies):
            own = "duplicate" if fault != "blank" and (repeated or copy) else fault
            if own:
                held[own] += 1
            initial = role[:1]
            if held["initial"] is not None and held["initial"] + initial not in ("su", "ua", "au"):
                held["illegal"] += 1
            held["initial"] = initial
            held["audit"].read(initial, own in ("blank", "duplicate"), own == "truncated")
    if held is not None:
        yield held


def audit_conversations(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`(key, gaps, blank, duplicate, truncated, illegal, cost, audit)`, a row for each conversation.

    `gaps` are the turns missing between the first and the last, `illegal` the neighbours whose initials are not su, ua or au; the
    others count rows by their first fault, but for `cost`.
    """
    found = _faults(_messages(rows, key, turn, role, text))
    kind = found.schema["key"].dataType.simpleString()

    def audits(batches):
        out = []

        def written():
            columns = [pa.array([r[c] for r in out], pa.int64()) for c in _COUNTS]
            return pa.RecordBatch.from_arrays([pa.array([r["key"] for r in out], key_type), *columns,
                                               pa.array([r["audit"] for r in out], pa.string())], names=["key", *_COUNTS, "audit"])

        key_type = None

        def noting():
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field("key").type
                yield batch

        for held in _audited(_runs(noting(), "key", "turn", "role", "fault", "repeated", "_copies")):
            held["cost"], held["audit"] = held["audit"].result()
            if held["turns"]:
                held["gaps"] = held["last"] - held["first"] + 1 - held["turns"]
            out.append(held)
            if len(out) >= 2000:
                yield written()
                out.clear()
        if out:
            yield written()

    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    ordered = found.repartition("key").sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.mapInArrow(audits, f"key {kind}, {counts}, audit string").withColumnRenamed("key", key)


def repair_conversations(rows: DataFrame, audits: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """`(key, place, edit, role, text)`: the messages that `audits` (of the same rows) leaves and makes, by place within a partition.

    The audit comes before the messages of its conversation in the stream. All messages of a conversation lie in one partition.
    """
    messages = _messages(rows, key, turn, role, text)
    headers = picked(audits, key=key, audit="audit")
    kind = messages.schema["key"].dataType.simpleString()

    def repaired(batches):
        feed = _runs(batches, "key", "audit", "role", "text")
        for key_value, audit, _, _ in feed:
            own = ((r, t) for _, _, r, t in feed)  # as many as the audit has letters for rows
            for place, (edit, role_now, text_now) in enumerate(applied(audit, own)):
                yield key_value, place, edit, role_now, text_now

    def stream(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        key_type = first.schema.field("key").type
        out, size = [], 0

        def written():
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (key_type, pa.int64(), pa.string(), pa.string(), pa.string()))],
                                              names=["key", "place", "edit", "role", "text"])

        def again():
            yield first
            yield from batches

        for row in repaired(again()):
            out.append(row)
            size += len(row[4])
            if size > 4 << 20 or len(out) >= 10_000:
                yield written()
                out, size = [], 0
        if out:
            yield written()

    both = headers.withColumn("header", F.lit(0)).unionByName(messages.withColumn("header", F.lit(1)), allowMissingColumns=True)
    ordered = both.repartition("key").sortWithinPartitions("key", "header", F.asc_nulls_first("turn"), "role", "digest")
    return (ordered.select("key", "audit", "role", "text")
            .mapInArrow(stream, f"key {kind}, place bigint, edit string, role string, text string").withColumnRenamed("key", key))


def conversation_hashes(repaired: DataFrame, key: str = "conv_id") -> DataFrame:
    """`(key, sha256)` of the messages as `role:text`, newline-joined; reads what `repair_conversations` gives as a stream, without a shuffle."""
    kind = repaired.schema[key].dataType.simpleString()

    def stream(batches):
        import hashlib

        held, out, key_type = None, [], None

        def written():
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], key_type), pa.array([h for _, h in out], pa.string())], names=["key", "sha256"])

        for batch in batches:
            key_type = batch.schema.field("key").type
            for key_value, place, role, text in _runs([batch], "key", "place", "role", "text"):
                if place == 0:
                    if held is not None:
                        out.append((held[0], held[1].hexdigest()))
                    held = (key_value, hashlib.sha256())
                else:
                    held[1].update(b"\n")
                held[1].update(f"{role}:{text}".encode())
            if len(out) >= 2000:
                yield written()
                out = []
        if held is not None:
            out.append((held[0], held[1].hexdigest()))
            yield written()

    rows = picked(repaired, key=key, place="place", role="role", text="text")
    return rows.mapInArrow(stream, f"key {kind}, sha256 string").withColumnRenamed("key", key)


def repair_report(keys: DataFrame, rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each distinct key of `keys`: counts, cost and audit of its conversation and the hash of what is left of it.

    A conversation without rows has zeros, no audit and the hash of the empty text.
    """
    audits = checkpointed(audit_conversations(rows, key, turn, role, text))
    hashes = conversation_hashes(repair_conversations(rows, audits, key, turn, role, text), key)
    own, left = picked(audits, _key=key, **{c: c for c in (*_COUNTS, "audit")}), picked(hashes, _hashed=key, sha256="sha256")
    every = picked(keys, key=key).distinct()
    return (every.join(own, F.col("key").eqNullSafe(F.col("_key")), "left").join(left, F.col("key").eqNullSafe(F.col("_hashed")), "left")
            .select(F.col("key").alias(key), *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _COUNTS),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
