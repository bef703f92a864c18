import hashlib
import random
import re

import pyarrow as pa
import pytest

from traceops.llm import automaton, secret_scan
from traceops.llm.secret_scan import BASE, MORE, Rule

RULES = BASE + MORE


def brute(text, rules=RULES):
    """Python's own matches of each rule, one rule after the other."""
    found = []
    for place, rule in enumerate(rules):
        for m in re.finditer(rule.head.replace("(", "(?:") + f"({rule.tail})", text or ""):
            if len(m[1]) >= rule.least:
                found.append((m.start(), place, rule.kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def spans(texts, rules=RULES):
    finder = secret_scan._Finder(rules, automaton.scanner(tuple(r.head + r.tail for r in rules)))
    return [[tuple(s.values()) for s in row] for row in finder.spans(pa.array(texts, pa.string())).to_pylist()]


PIECES = ["password", " PassWd", "secret", "TOKEN", "api_key", "apikey", "=", ":", '"', "'", " ", "   ", "AKIA", "A", "Z9", "0123456789abcdef", "abc",
          "deadbeef", "é", "中", "\n", ",", "x", ".", "-", "_", "ghp_", "a" * 20, "-----", "BEGIN ", "PRIVATE KEY", "eyJ", ".eyJab", "xoxb-", "sk_live_",
          "RSA ", "B" * 16, "AIza", "ſ", "K", "\x00"]


@pytest.mark.parametrize("lane", [1, 16, 2048])
def test_scan_finds_what_the_expressions_find(monkeypatch, lane):
    monkeypatch.setattr(automaton, "LANE", lane)
    rng = random.Random(lane)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", "-----BEGIN RSA PRIVATE KEY-----" * 2, "eyJab.eyJcd." + "x" * 20, "password = " * 300 + "longenough", "secret=token: abcdef",
              "token=password=ab", "0" * 24 + "g" + "f" * 23, "AKIA" + "Z" * 15, "AKIAKIA" + "Z" * 16]
    got = spans(texts)
    assert got == [brute(t) for t in texts]
    assert {kind for row in got for kind, _, _ in row} == {r.kind for r in RULES}


def test_other_rules_and_the_minimal_automaton():
    rng = random.Random(5)
    for head, tail in [("", "abc|ab|b"), ("(a|b)*", "c{2}"), ("x?", "[^x\\x41-\\x43]{1,3}"), ("", "a+b?"), ("\\.", "(ab)+")]:
        rules = (Rule("one", head, tail),)
        texts = ["".join(rng.choice("abcx.A ") for _ in range(rng.randint(0, 12))) for _ in range(400)]
        try:
            got = spans(texts, rules)
        except ValueError:
            assert (head, tail) in [("(a|b)*", "c{2}"), ("", "abc|ab|b"), ("\\.", "(ab)+")]
            continue
        # leftmost longest: the alternatives here are of one length or greedy
        assert got == [brute(t, rules) for t in texts], (head, tail)
    # the machine for one literal has a state for each letter read, and that is the least
    threads = automaton._Threads("abab")
    assert len(automaton.search_table(threads, automaton.byte_classes([threads])).to) == 5


@pytest.mark.parametrize("pattern", ["a(bc)?", "(", "[a", "a.b", "a{2,1", "", "a*", "\\d", "é"])
def test_refused_rules(pattern):
    with pytest.raises((ValueError, IndexError)):
        automaton.scanner((pattern,))


def test_rows_of_every_kind(spark, docs):
    rows = docs.collect()
    found = secret_scan.find_secrets(docs).collect()
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in found) == sorted((str(r.doc_id), brute(r.text)) for r in rows)
    long = "word " * 200_000 + "password: hunter2hunter2 " + "ab" * 500_000
    odd = spark.createDataFrame([(1, long, 0, "k"), (1, long, 0, "k"), (None, "token=abcdef", 0, "k"), (2, "é" * 3 + "AKIA" + "Z" * 16, 0, "k")],
                                "doc_id BIGINT, text STRING, spans INT, `key` STRING")
    digests = secret_scan.secret_digests(secret_scan.find_secrets(odd)).collect()
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in digests) == sorted(
        (str(r.doc_id), *(sum(k == kind for k, _, _ in brute(r.text)) for kind in ("assign", "access", "hex")),
         hashlib.sha256((t := ",".join(f"{k}:{a}:{b}" for k, a, b in brute(r.text))).encode()).hexdigest(), t) for r in odd.collect())
    none = secret_scan.secret_digests(secret_scan.find_secrets(docs.filter("doc_id < -1")))
    assert none.count() == 0 and none.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
