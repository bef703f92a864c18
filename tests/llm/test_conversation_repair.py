import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest

from traceops.llm import conversation_repair as repair
from traceops.llm.conversation_repair import Audit, Edits, applied, less, same

BLANK = "\t\n\x0b\x0c\r "


def every_repair(rows):
    """Cheapest (cost, audit, messages) of all ways to edit `rows` of (role, text, fault), by trying each."""
    insert = [[]] + [[("I", r)] for r in ("user", "assistant")] + [[("I", a), ("I", b)] for a in ("user", "assistant") for b in ("user", "assistant")]
    choices = []
    for role, text, fault in rows:
        own = [("D", None, 4)]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault == "truncated" else 0
            own += [("K", role, extra), ("R", "user", 3 + extra), ("R", "assistant", 3 + extra)]
        choices.append(own)
    best = None
    for edits in itertools.product(*choices):
        for inserts in itertools.product(insert, repeat=len(rows) + 1):
            audit, kept, cost = "", [], 0
            for i in range(len(rows) + 1):
                for letter, role in inserts[i]:
                    audit, cost = audit + letter, cost + 3
                    kept.append((role, ""))
                if i < len(rows):
                    letter, role, price = edits[i]
                    audit, cost = audit + letter, cost + price
                    if role is not None:
                        kept.append((role, rows[i][1]))
            if all(r for r, _ in kept) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept)):
                if best is None or (cost, audit) < best[:2]:
                    best = (cost, audit, kept)
    return best


def audited(rows):
    audit = Audit()
    for role, _, fault in rows:
        audit.read(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
    cost, letters = audit.result()
    return cost, letters, [(r, t) for _, r, t in applied(letters, iter([(r, t) for r, t, _ in rows]))]


def test_cheapest_repair_of_all():
    rng = random.Random(3)
    for _ in range(120):
        rows = [(rng.choice(["user", "user", "assistant", "assistant", "system", "tool", " ", ""]), f"t{i}", rng.choice(["", "", "", "blank", "truncated"]))
                for i in range(rng.randint(0, 3))]
        assert audited(rows) == every_repair(rows), rows


@pytest.mark.parametrize("prime", [repair._PRIME, 7, 1])
def test_order_of_prefixes_with_and_without_collisions(monkeypatch, prime):
    """With a small prime nearly all hashes collide, and only the verification tells texts apart."""
    monkeypatch.setattr(repair, "_PRIME", prime)
    rng = random.Random(prime)
    nodes = [Edits()]
    for _ in range(600):
        nodes.append(Edits(rng.choice(nodes[-40:]), rng.choice("DIKR")))
    for _ in range(4000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert less(a, b) == (str(a) < str(b)) or str(a) == str(b)
        depth = min(a.depth, b.depth)
        assert same(a.at(depth), b.at(depth)) == (str(a)[:depth] == str(b)[:depth])


def test_prefixes_share_their_nodes():
    """A long conversation keeps a handful of letters a row, not a text for each state and row."""
    audit = Audit()
    for i in range(20_000):
        audit.read("ua"[i % 2] if i % 7 else "s", i % 11 == 0, i % 13 == 0)
    nodes, todo = set(), [held[1] for held in audit.best if held]
    while todo:
        node = todo.pop()
        while node.depth and id(node) not in nodes:
            nodes.add(id(node))
            node = node.back[0]
    cost, letters = audit.result()
    assert len(nodes) < 3 * len(letters) and sum(letters.count(e) for e in "DKR") == 20_000


def by_hand(rows):
    """The report from plain lists, one conversation after the other."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, judged, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for turn, role, text in own:
            left = text.strip(BLANK)
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
            if fault:
                n[fault] += 1
        turns = [t for t, _, _ in own if t is not None]
        cost, letters, kept = audited(judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n.values(), illegal, cost, letters,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, audit STRING, `key` STRING, cost INT, header INT"


def test_odd_rows_against_lists(spark):
    rng = random.Random(8)
    texts = ["Yes.", "No!", "cut", "", " \t\n", None, "Ünï中.", "x" * 200_000 + "?", "end. \r\n", " "]
    rows = [(rng.choice([1, 2, 3, 4, None]), rng.choice([None, 0, 1, 2, 3, 9, -4]), rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(texts)) for _ in range(120)]
    rows += [(7, i, "user" if i % 2 else "assistant", f"message {i % 900}.") for i in range(3000)]  # one long conversation
    rows += [(8, 5, "user", "the same.")] * 400 + rows[:10]
    frame = spark.createDataFrame([(*r, "a", "k", 0, 1) for r in rows], SCHEMA)
    keys = spark.createDataFrame([(*r, "a", "k", 0, 1) for r in [*rows, (99, 0, "user", "dropped.")]], SCHEMA)
    want = by_hand(rows)
    want[99] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = repair.repair_report(keys, frame).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want and len(got) == len(want)
    audits = repair.audit_conversations(frame).filter("conv_id = 7")
    messages = repair.repair_conversations(frame.filter("conv_id = 7"), audits).orderBy("place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in messages)) and [r.place for r in messages] == list(range(len(messages)))


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.audit_conversations(none).count() == 0 and repair.repair_report(none, none).count() == 0
