import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from traceops.llm import decontam, html_text, jaccard, line_dedup, neighbour_graph, packing, phrases, quality, secret_scan, token_files, toxicity, url_filter
from traceops.llm.components import components
from traceops.llm.encoder import Encoder, encoder
from traceops.llm.storage import checkpointed, shared_folder

VOCABULARY = "byte_bpe_50k.json"


PLAIN = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def empty(docs):
    return docs.filter("doc_id < -1")


# --- 1, 3: ids ----------------------------------------------------------------

def test_chunks_encode_like_whole_texts():
    rng = random.Random(1)
    parts = ["a", "b", " ", "\n", ".", ",", "!", "'", "s", "1", "é", "中", "\t", "A", "$", "<|", "word", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    offsets, ids = encoder(VOCABULARY).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == plain_ids(text), text


def test_words_are_encoded_once_whatever_signs_follow():
    texts = [f"word{sign * k} {k} été{sign}{k}\nline{sign * 2}" for k in range(1, 9) for sign in "#%$&*.,!?;:)-="]
    own, seen = Encoder(VOCABULARY), []

    class Model:
        def tokenize(self, word):
            seen.append(word)
            return PLAIN.model.tokenize(word)

    whole, own.model = own.whole, Model()
    own.whole = lambda some: seen.extend(some) or whole(some)
    offsets, ids = own.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain_ids(t) for t in texts]
    assert not [x for x in seen if x[:1] in " \n" and x[1:2].isalpha()]
    assert sum(x.endswith("word") for x in seen) == 1


def test_encoder_remembers_short_chunks_only(monkeypatch):
    monkeypatch.setattr("traceops.llm.encoder.CACHE_WORDS", 40)
    own = Encoder(VOCABULARY)
    for k in range(4):  # the cache fills in the second round
        texts = [f"word{'abcdefghij'[i]}{'xyzw'[k]} a'b{i} c\nnew{'abcdefghij'[i]} {'long' * 40}{k}'z" for i in range(10)]
        for _ in range(2):
            offsets, ids = own.encode(pa.array(texts))
            assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain_ids(t) for t in texts]
        assert len(own.cache[0]) <= 40 and max(map(len, own.cache[0].to_pylist())) <= 64


def test_token_files_round_trip(spark, docs):
    path = shared_folder(spark, "test-tokens")
    token_files.write_tokens(docs, path)
    got = sorted(map(tuple, token_files.token_digests(spark, path).collect()), key=lambda r: r[1])
    rows = docs.collect()
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter(
        (r.doc_id, len(plain_ids(r.text)) + 1, crc([*plain_ids(r.text), 2])) for r in rows)
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    known = [r[0] for r in got if r[0] is not None]
    assert known == sorted(known)
    one = token_files.read_tokens(spark, path, [7]).collect()
    assert [np.frombuffer(r.ids, "<u2").tolist() for r in one] == [[*plain_ids(next(r.text for r in rows if r.doc_id == 7)), 2]]


def test_token_files_of_an_empty_table(spark, docs):
    path = shared_folder(spark, "test-tokens")
    token_files.write_tokens(empty(docs), path)
    assert token_files.token_digests(spark, path).count() == 0


def test_packs_hold_each_length_once():
    rng = random.Random(2)
    histogram = {rng.randint(1, 63): rng.randint(1, 500) for _ in range(40)}
    packs = packing.pack_histogram(histogram, 64)
    held = Counter()
    for lengths, count in packs:
        assert sum(lengths) <= 64
        for length in lengths:
            held[length] += count
    assert held == histogram
    used = sum(k * n for k, n in histogram.items())
    # longest first into the emptiest pack needs at most a quarter more packs than the best way
    assert sum(n for _, n in packs) <= 1.25 * max(-(-used // 64), sum(n for k, n in histogram.items() if k > 32)) + 1


def test_packing_of_odd_rows(spark, docs):
    rows = packing.pack_documents(docs).collect()
    pieces = Counter()
    for r in docs.collect():
        ids = [*plain_ids(r.text), 0]
        for a in range(0, len(ids), 1024):
            pieces[r.doc_id, a, len(ids[a:a + 1024]), crc(ids[a:a + 1024]), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == pieces
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(empty(docs)).count() == 0


# --- 2: pages -----------------------------------------------------------------

PAGE = ('<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><a href=x>menu</a></nav><div class="ad">buy</div>'
        '<article><h1>Head &amp; tail</h1><p><b>One  two<br>three<p>four &eacute;</p><div class="share">share</div><form>f</form></article>'
        '<section id="comments"><p>reader</p></section><footer>foot</footer></body></html>')


def test_pages(spark):
    rows = [(1, "http://A.org/x", PAGE), (2, "http://a.org/y", None), (3, None, ""), (4, "no host", "<p>plain"), (1, "http://A.org/x", PAGE),
            (None, "http://a.org/z", "<article>cut <b>off <i")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id BIGINT, url STRING, html STRING, text STRING")
    want = Counter({(1, "Head & tail\nOne two three\nfour é"): 2, (2, ""): 1, (3, ""): 1, (4, "plain"): 1, (None, "cut off"): 1})
    for hosts in (html_text.BROADCAST_HOSTS, 0):
        got = html_text.extract_pages(pages, broadcast_hosts=hosts).collect()
        assert Counter((r.page_id, r.text) for r in got) == want
        assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract_pages(pages.filter("page_id < 0")).count() == 0


def test_no_running_text_is_left_beside_a_container(spark):
    body = "body text " * 30
    first = f"<body><article><h1>Title</h1><p>lead</p><div class='body'><p>{body}</p></div></article></body>"
    other = f"<body><article><p>{body * 2}</p><div class='body'><p>boxed</p></div></article></body>"
    plain = f"<body><p>intro</p><div class='body'><p>{body}</p></div></body>"
    links = f"<body><div><a href='/'>Home page</a> <a href='/x'>Other pages</a></div><div class='body'><p>{body}</p></div></body>"
    text = body.strip()
    assert html_text.main_text(first, None)[0] == f"Title\nlead\n{text}"
    assert html_text.main_text(first, ">body>article>div.body")[0] == f"Title\nlead\n{text}"
    assert html_text.main_text(other, ">body>article>div.body")[0] == f"{(body * 2).strip()}\nboxed"
    assert html_text.main_text(plain, None)[0] == f"intro\n{text}"
    assert html_text.main_text(links, None) == (text, ">body>div.body")
    pages = spark.createDataFrame([(i, "http://a.org/x", p) for i, p in enumerate([first, first, other])], "page_id BIGINT, url STRING, html STRING")
    got = {r.page_id: r.text for r in html_text.extract_pages(pages).collect()}
    assert got == {0: f"Title\nlead\n{text}", 1: f"Title\nlead\n{text}", 2: f"{(body * 2).strip()}\nboxed"}


def test_names_inside_the_article_and_inline_elements():
    inside = lambda part: html_text.main_text(f"<body><nav>m</nav><article><p>one</p>{part}<p>two</p></article></body>", None)[0]
    for kept in ('<div class="side-by-side">x</div>', '<div class="legal-analysis">x</div>', '<section id="related-work">x</section>',
                 '<div id="social-history">x</div>', '<div class="footnotes">x</div>', "<p><span class=lead>x</span></p>"):
        assert inside(kept) == "one\nx\ntwo", kept
    for gone in ('<div class="ad">x</div>', '<div class="share">x</div>', '<div class="share-buttons">x</div>', '<div class="related_posts">x</div>',
                 '<div id="comments">x</div>', "<div hidden>x</div>", '<p><span class="advert">x <b>y</b></span></p>', "<p><span hidden>x</span></p>",
                 '<a class="skip-link" href="#">x</a>', '<p><span class="ad">x<span>y</span>z</span></p>', '<p><span class="ad">never closed</p>'):
        assert inside(gone) == "one\ntwo", gone
    assert inside('<p>a <span class="ad">x</span> b</p>') == "one\na b\ntwo"
    outside = '<div class="legal-notes">x</div><div class="my-sidebar-2">y</div><div><p>text</p></div>'
    assert html_text.main_text(f"<body>{outside}</body>", None)[0] == "text"


def test_no_text_is_dropped_by_tag_or_by_a_literal_sign():
    for page, want in (("if a < b then c", "if a < b then c"), ("<p>x</p>1 < 2 and 3 <", "x\n1 < 2 and 3 <"), ('cut <a href="x', "cut"),
                       ("<article><p>one<figure><pre>code</pre><figcaption>caption</figcaption></figure><p>two</article>", "one\ncode\ncaption\ntwo"),
                       ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", "so x=1 holds"),
                       ("<p>a</p><object data='x'><p>instead</p></object><p>b</p>", "a\ninstead\nb"),
                       ("<p>a</p><fieldset><p>boxed</p></fieldset>", "a\nboxed"),
                       ("<p>a <svg><text>drawn</p><p>b</p>", "a\nb"), ("<p>a <svg>one</svg> b</p>", "a b"),
                       ("<p>a <select><option>x</p><p>b <select><option>y</select> c</p>", "a\nb c"),
                       ("<noscript><p>off</p></noscript><p>b</p>", "b"), ("<p>a</p><script>if (a < b) '</p>'", "a")):
        assert html_text.main_text(page, None)[0] == want, page


# --- 4, 6: classifiers ----------------------------------------------------------

def labelled(spark, d="/root/testdata/sf0.1"):
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


@pytest.mark.parametrize("score, label, least", [(quality.score_quality, "quality", 0.99), (toxicity.score_toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, score, label, least):
    docs, labels = labelled(spark)
    rows = score(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
    assert sum(a == b for a, b in rows) / len(rows) >= least


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_scores_of_odd_rows(spark, docs, score):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (99, 1, 1), (None, 1, 0)], "doc_id BIGINT, quality INT, toxic INT")
    for known in (labels, labels.filter("doc_id < 0")):
        rows = score(docs, known).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
        assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert score(empty(docs), labels).count() == 0


def test_obfuscated_words_are_restored():
    words = ["stupid", "loser", "moron", "trash", "plain", "words", "trust", "stones", "lost", "paste", "idiot"]
    texts = pa.array([" ".join(words)] * 20)
    model = toxicity.log_probabilities(toxicity.trigram_counts(texts)).tolist()
    for written, meant in (("5tupid", "stupid"), ("l0$er", "loser"), ("m.o.r.o.n", "moron"), ("trrrrash", "trash"), ("1d10t", "idiot")):
        assert toxicity.decode(written, model) == meant
    _, sign, names = toxicity.signs(pa.array(["so s t u p i d here", "l0$er!!"]), model)
    found = {names[i] for i in sign}
    assert {"stupid", "loser"} <= found


def test_doubled_and_spaced_words_are_restored():
    words = ["stupid", "loser", "moron", "trash", "plain", "words", "trust", "stones", "lost", "paste", "idiot", "a", "i", "y", "a", "i", "you", "are"]
    model = toxicity.log_probabilities(toxicity.trigram_counts(pa.array([" ".join(words)] * 20))).tolist()
    for written, meant in (("stuupid", {"stupid"}), ("iddiot", {"idiot"}), ("sttuuppiidd!", {"stupid"}), ("so a m o r o n here", {"moron"}),
                           ("So I i d i o t.", {"idiot"}), ("s t u p i d  l o s e r", {"stupid", "loser"}), ("a m 0 r 0 n", {"moron"}),
                           ("you are a i d i 0 t, l 0 0 s e r", {"idiot", "loser"}), ("s t u p i d", {"stupid"})):
        _, sign, names = toxicity.signs(pa.array([written]), model)
        assert meant <= {names[i] for i in sign}, written
    lexicon = toxicity.Lexicon(["stupid", "loser", "moron"], np.log1p(-np.array([0.9, 0.9, 0.9])), model)
    weight = lexicon.weight(pa.array(["stupid", "stuupid", "s t u p i d", "a m o r o n", "s t u p i d l o s e r", "plain words", "a i y a i", ""]))
    assert np.allclose(weight / weight[0], [1, 1, 1, 1, 2, 0, 0, 0])


# --- 5: lines -------------------------------------------------------------------

def runs_by_hand(rows, least):
    """Places to cut in each (key, text), from lists of all units."""
    def units(text):
        found, start = [], 0
        for end in [m.end() for m in re.finditer(r"[.!?] +|\n", text or "")] + [len(text or "")]:
            words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), (text or "")[start:end]))
            if words:
                found.append((start, end, tuple(words)))
            start = end
        return found

    rank = lambda key: float("inf") if key is None else key
    first = {}
    for key, text in rows:
        for _, _, words in units(text):
            first[words] = min(first.get(words, rank(key)), rank(key))
    out = []
    for key, text in rows:
        seen, run, cut = set(), [], []
        for unit in [*units(text), None]:
            if unit and (first[unit[2]] < rank(key) or unit[2] in seen):
                run.append(unit)
            else:
                if sum(len(u[2]) for u in run) >= least:
                    cut.append((run[0][0], run[-1][1] - run[0][0]))
                run = []
            if unit:
                seen.add(unit[2])
        out.append(cut)
    return out


SHARED = "Alpha beta gamma delta. Epsilon zeta eta theta iota! " + " ".join(f"kappa{i}" for i in range(25)) + ". Lambda mu? "


def test_passages_are_cut_with_their_places(spark, docs):
    columns = "doc_id BIGINT, text STRING, removed_ STRING, _key STRING, _version INT, units STRING, `key` INT, high INT"
    rng = random.Random(4)
    own = lambda: " ".join(rng.choice(["own", "words", "of", "this.", "Text", "here!", "now\n"]) + str(rng.random())[2:6] for _ in range(30))
    texts = [(1, "Host one. " + SHARED + "Ends here."), (2, "other words " + SHARED.upper() + own()), (3, own() + "\n" + SHARED.replace(" ", "\n")),
             (None, own() + ". " + SHARED), (4, "Alpha beta gamma delta. Only one sentence of it."), (5, SHARED * 3), (5, "x. " + SHARED), (6, SHARED.strip()),
             (0, "a. b. c. " * 40), (7, None), (8, ""), (8, "\n \n"), (9, "a. b.\u00a0c\u2003d. e\x1cf " + SHARED)]
    texts += [(i, own()) for i in range(10, 30)] + texts[:4]
    frame = spark.createDataFrame([(*t, "s", "k", 1, "u", 2, 3) for t in texts], columns).repartition(3)
    got = line_dedup.dedup_lines(frame).collect()
    want = Counter()
    for (key, text), cut in zip(texts, runs_by_hand(texts, line_dedup.RUN_WORDS)):
        left = text
        for start, length in reversed(cut):
            left = left[:start] + left[start + length:]
        want[key, left, tuple(cut)] += 1
    assert Counter((r.doc_id, r.text, tuple(map(tuple, r.removed))) for r in got) == want
    assert sum(bool(c) for _, _, c in want) >= 6
    assert line_dedup.dedup_lines(frame).columns == [*frame.columns, "removed"]
    assert {tuple(r)[2:8] for r in got} == {("s", "k", 1, "u", 2, 3)}
    named = line_dedup.dedup_lines(frame.withColumnRenamed("high", "removed"), removed="places").collect()
    assert Counter(tuple(map(tuple, r.places)) for r in named) == Counter(tuple(map(tuple, r.removed)) for r in got)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter((r.doc_id, len(r.removed)) for r in line_dedup.dedup_lines(docs, run_words=5).collect()) == Counter(
        (key, len(cut)) for (key, _), cut in zip(rows, runs_by_hand(rows, 5)))
    assert line_dedup.dedup_lines(empty(docs)).count() == 0


# --- 7: urls --------------------------------------------------------------------

def test_rules_against_brute_force(spark):
    rng = random.Random(3)
    hosts = ["a.org", "b.a.org", "org", "x.com", "y.x.com", "", "c.net", "A.ORG", "aorg"]
    urls = [None, "", "nothing", "http://", "://x.com/en/1"] + [
        f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en/1', '/en/12?q', '/fr#x', '//', '?x'])}" for _ in range(400)]
    allow, block = [("org", "/"), ("x.com", "/en/1")], [("a.org", "/en/"), ("com", "/"), ("net", "/fr")]
    pages = spark.createDataFrame([(i, u, "r", 1) for i, u in enumerate(urls)], "page_id BIGINT, url STRING, rule STRING, host INT")
    for r in url_filter.filter_urls(pages, allow, block).collect():
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, rules in (("allow", allow), ("block", block)) for h, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[1], best[2])
    assert url_filter.filter_urls(pages.filter("page_id < 0"), allow, block).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, [], []).collect()} == {"allow"}


def test_cascade_is_exact_with_many_keys(spark):
    listed = [f"k{i}" for i in range(0, 4000, 4)]
    universe = spark.createDataFrame([(f"k{i}",) for i in range(4000)], "key STRING")
    cascade = url_filter.build_cascade(universe, listed, 4000)
    assert len(cascade.levels) > 1
    got = {r.key for r in universe.filter(cascade.holds(F.col("key"))).collect()}
    assert got == set(listed)


# --- 8: benchmark ---------------------------------------------------------------

def slow_align(item, text):
    table = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item):
        for j, b in enumerate(text):
            table[i + 1, j + 1] = max(0, table[i, j] + (2 if a == b else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
    return table.max()


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(4)
    for _ in range(200):
        item, text = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(-1, 4, rng.integers(0, 25))
        score, a, b = decontam.align(item, text)
        assert score == slow_align(item, text)
        assert slow_align(item, text[a:b]) == score


def test_edited_passages_are_found(spark, docs):
    words = [f"word{i}" for i in range(30)]
    edited = [w for i, w in enumerate(words) if i != 9]
    edited[3], edited[17:17] = "Other", ["more"]
    own = "something else. " + ", ".join(edited).upper() + " and then the end"
    more = spark.createDataFrame([(50, own, "s", 0, "k"), (51, "word1 word2 word3 alone", "s", 0, "k")], docs.schema)
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "two words"), (3, None), (4, "")], "item_id BIGINT, text STRING")
    for rare in (0, 1000):
        rows = decontam.find_contamination(docs.union(more), bench, rare=rare).collect()
        assert [(r.doc_id, r.item_id) for r in rows] == [(50, 1)]
        assert rows[0].score == pytest.approx((2 * 28 - 3) / 60, abs=0.04)
        assert own[rows[0].start:rows[0].end].startswith("WORD0") and own[rows[0].start:rows[0].end].endswith("WORD29")
    left = decontam.clean_documents(docs.union(more), bench).collect()
    assert len(left) == docs.count() + 1
    assert decontam.find_contamination(docs, bench.filter("item_id < 0")).count() == 0
    assert decontam.find_contamination(empty(docs), bench).count() == 0


@pytest.mark.parametrize("text", [16 << 20, 0])
def test_much_edited_passages_are_found_like_by_alignment_of_all_pairs(spark, monkeypatch, text):
    monkeypatch.setattr(decontam, "BROADCAST_TEXT", text)
    items = {i: [f"i{i}w{k}" for k in range(size)] for i, size in enumerate((14, 16, 24, 36, 59))}
    docs = {}
    for item in items.values():
        for every in (5, 4):  # one word in five or four is another one
            docs[len(docs)] = [f"d{len(docs)}n{k}" if k % every == every - 2 else w for k, w in enumerate(["before", *item, "after"])]
    rng = random.Random(3)
    for i, item in items.items():
        docs[len(docs)] = [f"r{i}n{k}" if rng.random() < 0.3 else w for k, w in enumerate(item)]
    docs[len(docs)] = items[2]  # an exact copy beside the edited ones
    want = {(d, i) for d, text in docs.items() for i, item in items.items()
            if slow_align(item, text) >= decontam.LEAST_SCORE * decontam.MATCH * len(item)}
    assert len(want) >= 11
    table = spark.createDataFrame([(d, " ".join(x)) for d, x in docs.items()], "doc_id BIGINT, text STRING")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in items.items()], "item_id BIGINT, text STRING")
    assert {(r.doc_id, r.item_id) for r in decontam.find_contamination(table, bench).collect()} == want
    left = {r.doc_id for r in decontam.clean_documents(table, bench).collect()}
    assert left == set(docs) - {d for d, _ in want}


# --- 9: neighbours --------------------------------------------------------------

def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(600, 16))
    vectors[100:300] = vectors[100]  # a third are copies
    rows = [(i, [float(x) for x in v], "s", 1) for i, v in enumerate(vectors)]
    odd = [(1000, None, "s", 1), (1050, [], "s", 1), (1100, [0.0] * 16, "s", 1), (1150, [float("nan")] * 16, "s", 1), (None, [1.0] * 16, "s", 1),
           (1200, [1.0] * 3, "s", 1), (0, rows[0][1], "s", 1)]
    table = spark.createDataFrame(rows + odd, "vec_id BIGINT, embedding ARRAY<DOUBLE>, score STRING, node INT")
    got = defaultdict(list)
    for r in neighbour_graph.nearest(table, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 50))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in got:
        score = np.round(unit @ unit[q], 12)
        want = sorted((i for i in range(600) if i != q), key=lambda i: (-score[i], i))[:5]
        hits += len(set(want) & {i for i, _ in got[q]})
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
    assert hits >= 0.95 * 5 * len(got)
    assert neighbour_graph.nearest(table.filter("vec_id < 0"), lambda i: i % 50 == 0).count() == 0


def scores(vectors, q):
    return [float(np.dot(vectors[q], x) / (np.sqrt(np.dot(vectors[q], vectors[q])) * np.sqrt(np.dot(x, x)))) for x in vectors]


def by_force(vectors, q, k=5):
    score = scores(vectors, q)
    return sorted((i for i in range(len(vectors)) if i != q), key=lambda i: (-score[i], i))[:k]


def test_small_tables_at_many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for size in (3, 12):
            vectors = np.random.default_rng(size).normal(size=(size, 8))
            table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
            got = defaultdict(list)
            for r in neighbour_graph.nearest(table, lambda i: i % 4 == 0).orderBy("query_id", "rank").collect():
                got[r.query_id].append(r.vec_id)
            assert got == {q: by_force(vectors, q) for q in range(0, size, 4)}
        # queries without edges
        nodes, _ = neighbour_graph.nodes_of(neighbour_graph.valid_vectors(table, "vec_id", "embedding"), 6)
        graph = neighbour_graph.neighbour_graph(nodes).filter("node != 0")
        found = neighbour_graph.greedy_search(nodes.select("node").filter("node < 2"), graph, nodes).collect()
        assert {r.found for r in found if r.node == 0} == set(range(1, 12))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_neighbours_among_vectors_alike_in_16_bits(spark):
    rng = np.random.default_rng(9)
    one, other = np.array([1, 0, 0, 0, 0, 0, 0, 0.0]), rng.normal(size=8)
    vectors = np.array([one * rng.integers(1, 9) + rng.normal(size=8) * 1e-6 for _ in range(700)]  # one 16-bit form
                       + [other * 2.0 ** (i % 5) for i in range(100)] + list(rng.normal(size=(100, 8))))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = defaultdict(list)
    for r in neighbour_graph.nearest(table, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert set(got) == set(range(0, 900, 50))
    assert {q: got[q] for q in range(0, 800, 50)} == {q: by_force(vectors, q) for q in range(0, 800, 50)}


# --- 10: near copies ------------------------------------------------------------

def brute_components(rows):
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.setdefault(key, frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else []))
    label = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and label[b] < label[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a], changed = label[b], True
    return {k: (len(s), label[k]) for k, s in sets.items()}


def test_near_copies_against_brute_force(spark):
    rng = random.Random(6)
    base = [[f"v{rng.randint(0, 400)}" for _ in range(rng.randint(3, 80))] for _ in range(6)]
    rows = [(0, None), (1, ""), (2, "A b"), (3, "a  B")]
    for i in range(4, 160):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 400)}"
        rows.append((i, " ".join(words + ["common line that all share here"] * rng.randint(0, 1))))
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id BIGINT, text STRING, n BIGINT")
    want = brute_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(table).collect()}
    assert got == want
    kept = {r.doc_id for r in jaccard.one_of_each(table).collect()}
    assert kept == {c for _, c in want.values()}


def test_near_copies_of_odd_rows(spark, docs):
    rows = jaccard.jaccard_components(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    assert {(r.doc_id, r.component_id) for r in rows if r.n_shingles == 0} == {(3, 3), (4, 4), (5, 5)}
    assert {r.component_id for r in rows if r.doc_id in (8, 9)} == {8}
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 2, 3, 4, 5, None, 6, 7, 8])
    assert jaccard.jaccard_components(empty(docs)).count() == 0


def shuffle_files(spark):
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f: f.stat().st_size for place in places for f in Path(place).rglob("shuffle_*.data")}


def test_only_sets_in_a_pair_are_shuffled(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, 500, sorted(rng.integers(0, 2**62, 500).tolist())) for i in range(1500)]
    rows.append((1500, 500, rows[7][2]))
    sets = checkpointed(spark.createDataFrame(rows, "uid BIGINT, n BIGINT, hashes ARRAY<BIGINT>"))
    before = set(shuffle_files(spark))
    monkeypatch.setattr(jaccard, "freed", lambda table: None)
    pairs = spark.createDataFrame([(1500, 7), (7, 8), (1500, 7)], "a BIGINT, b BIGINT").hint("merge")  # as made by joins: of unknown size
    found = jaccard.links(pairs, sets).collect()
    assert [tuple(r) for r in found] == [(1500, 7)]
    # all sets have 6 MB
    assert sum(size for f, size in shuffle_files(spark).items() if f not in before) < 500_000


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- columns of any name ------------------------------------------------------------

CLASHING = ["_key", "_version", "_uid", "_component_id", "_component", "_words", "_place", "_places", "component", "component_id", "uid", "key", "version",
            "n", "units", "number", "start", "length", "words", "high", "low", "copy", "first", "hash", "shared", "bits", "hashes", "item", "items", "gram", "place",
            "pair_key", "pair_version", "score", "predicted", "held_out", "features", "kept", "twice", "n_shingles", "removed"]


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents that repeat ids, with nulls and very long texts, and a column of every name that the operators use themselves."""
    line = " ".join(f"w{i}" for i in range(60))
    texts = [(1, line), (1, line), (1, "another text of this id " + line), (2, line + " more"), (None, line), (3, None), (4, ""), (5, " "), (6, line + " " + line),
             (7, " ".join(f"v{i}" for i in range(30_000))), (8, "short")]
    rows = [(i, t, "en", "s", len(t or ""), *(f"{c}{n}" for c in CLASHING)) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, " + ", ".join(f"`{c}` STRING" for c in CLASHING))


def test_stages_keep_columns_of_any_name(spark, clashing):
    source = {tuple(r) for r in clashing.collect()}
    bench = spark.createDataFrame([(1, " ".join(f"v{i}" for i in range(100, 140))), (1, "x y z"), (2, "short"), (3, None)], "item_id BIGINT, text STRING")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (6, 1, 1), (7, 0, 0)], "doc_id BIGINT, quality INT, toxic INT")
    one = jaccard.one_of_each(clashing)
    assert one.columns == clashing.columns and {tuple(r) for r in one.collect()} <= source
    assert sorted(str(r.doc_id) for r in one.collect()) == ["1", "3", "4", "5", "7", "8", "None"]  # 6 is a near copy of 1
    clean = decontam.clean_documents(clashing, bench)
    assert clean.columns == clashing.columns and {tuple(r) for r in clean.collect()} == {r for r in source if r[0] not in (7, 8)}
    cut = line_dedup.dedup_lines(clashing, removed="cut")
    assert cut.columns == [*clashing.columns, "cut"]
    assert {tuple(r)[2:-1] for r in cut.collect()} == {r[2:] for r in source}
    good = quality.good_documents(clashing, labels)
    assert good.columns == clashing.columns and {tuple(r) for r in good.collect()} <= source
    for rows in (secret_scan.find_secrets(clashing), packing.pack_documents(clashing), toxicity.score_toxicity(clashing, labels),
                 phrases.collocations(clashing)):
        rows.collect()


def test_pieces_of_many_tasks_are_spread_over_the_groups(spark):
    """Each task counts its pieces from its own number on, so the first ones do not come together."""
    docs = spark.range(640).selectExpr("id AS key", "concat('text number ', id, ' of some words') AS text").repartition(64)
    groups = []
    count = type(docs).groupBy

    def note(self, *by):
        if by == ("range",):
            groups.append(self.groupBy_("range").count().collect())
        return count(self, *by)

    type(docs).groupBy_, type(docs).groupBy = count, note
    try:
        jaccard.first_filter(docs, 57).count()
    finally:
        type(docs).groupBy = count
        del type(docs).groupBy_
    held = [r["count"] for r in groups[0] if r.range >= 57]
    assert len(held) > 40 and max(held) <= 6
