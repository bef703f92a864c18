import random
import re
from collections import Counter

import numpy as np
import pytest

from traceops.llm import phrases

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, phrase STRING, `count` INT, known STRING, size INT, shard STRING"


def by_hand(rows, least, longest, top=2000, covered=50):
    """Phrases of plain lists: every one counted, none left out before the end."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in candidates.items():
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        if not any(other == lang and len(longer) > len(words) and 100 * b >= covered * a
                   and any(longer[i:i + len(words)] == words for i in range(len(longer))) for (other, longer), b in candidates.items()):
            out.setdefault(lang, []).append((*min(cuts), a, " ".join(words)))
    result = set()
    for lang, found in out.items():
        found.sort(key=lambda c: (-c[0], -c[4], c[5].encode()))
        result |= {(lang, rank, p, a, l, r, n[lang], score) for rank, (score, _, l, r, a, p) in enumerate(found[:top], 1)}
    return result


def some_texts(seed, count=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["Big", "big", "É", "é", "中文", "a\x00b", "don't", "x y"]
    signs = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!? ", ";", ":\x0b"]
    rows = []
    for _ in range(count):
        weights = [1 / (i + 1) for i in range(len(words))]
        text = "".join(w + rng.choice(signs) for w in rng.choices(words, weights, k=rng.randint(0, 30)))
        rows.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", "fr"), (" .,\t", "fr"), ("one", "fr")] + [("new york city hall", "en")] * 12 + [("same same same same same", "de")] * 5


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i % 7, t, lang, "p", 1, "s", 2, "x") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("shards, longest, least, places, task_words", [(3, 3, 10, 1 << 24, 10 ** 6), (1, 3, 10, 1 << 24, 10 ** 6), (4, 4, 5, 1 << 15, 50),
                                                                        (2, 2, 3, 1 << 24, 100), (5, 5, 4, 1 << 24, 10 ** 6)])
def test_counting_in_a_cycle_against_lists(spark, shards, longest, least, places, task_words):
    rows = some_texts(shards * 10 + longest)
    got = phrases.collocations(frame(spark, rows), least=least, longest=longest, top=40, shards=shards, places=places, task_words=task_words).collect()
    want = by_hand(rows, least, longest, top=40)
    assert {tuple(r) for r in got} == want and len(got) == len(want) and len(want) > 15


def test_phrases_that_share_a_place_are_still_exact():
    """With a single place every phrase starts as soon as one word or pair is frequent: more is counted, a whole cycle each."""
    since = [np.array([0], np.uint8), np.array([phrases.NEVER], np.uint8)]
    for step, expected in ((0, {("a", 0)}), (1, {("a", 0), ("a b", 1), ("b", 0), ("b a", 1)}), (3, {("a b", 1), ("b a", 1)}), (4, set())):
        counter = phrases._Counter(step, 3, 3, since)
        counter.add("en", b"a b a" if step else b"a")
        rows = {(p, s) for batch in counter.flush() for p, s in zip(batch.column("phrase").to_pylist(), (k >> 32 for k in batch.column("known").to_pylist()))}
        assert rows == expected, step


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_words_are_numbered_by_blocks(monkeypatch, block):
    monkeypatch.setattr(phrases, "BLOCK", block)
    rows = [(t, lang or "und") for t, lang in some_texts(block, 200)]
    counter = phrases._Counter(1, 2, 3, [np.zeros(1 << 15, np.uint8), np.zeros(1 << 15, np.uint8)])
    for text, lang in rows:
        counter.add(lang, (text or "").encode())
    counter._number()
    arrays = [x for texts in counter.texts.values() for x in texts]
    assert all(len(x.dictionary) == len(set(x.dictionary.to_pylist())) for x in arrays) and len(arrays) > (8 if block < 100 else 3)
    got = Counter()
    for batch in counter.flush():
        for lang, phrase, count in zip(*(batch.column(n).to_pylist() for n in ("lang", "phrase", "count"))):
            got[lang, phrase] += count
    want = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            want.update((lang, " ".join(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    assert got == want


def test_rare_phrases_are_not_written_after_their_cycle(spark, monkeypatch):
    tables, whole = [], phrases.checkpointed

    def written(df, *by, **more):
        table = whole(df, *by, **more)
        if "known" in df.columns:
            tables.append([tuple(r) for r in table.select("size", "count", "known").collect()])
        return table

    monkeypatch.setattr(phrases, "checkpointed", written)
    rows = some_texts(5)
    counts, words = phrases.count_phrases(frame(spark, rows), least=10, longest=3, shards=2)
    assert {r.lang: r.n for r in words.collect()} == {r[0]: r[6] for r in by_hand(rows, 1, 3, 1)} | {"fr": 1}
    assert len(tables) >= 4 and any(c < 10 for size, c, _ in tables[1] if size == 1) and any(c < 10 for size, c, _ in tables[1] if size == 2)
    for step, table in enumerate(tables[2:], 2):
        assert table and not [r for r in table if r[1] < 10 and (r[2] >> 32) + 2 <= step + 1]


def test_long_texts_in_chunks(spark):
    text = "alpha beta gamma, delta " * 100_000 + "x" * 3_000_000 + " alpha beta"
    got = phrases.collocations(frame(spark, [(text, "en")], 1)).collect()
    assert {tuple(r) for r in got} == by_hand([(text, "en")], 10, 3)


def test_no_documents(spark):
    none = frame(spark, [("x", "y")], 1).filter("doc_id < 0")
    assert phrases.collocations(none).count() == 0
