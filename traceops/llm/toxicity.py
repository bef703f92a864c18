"""Toxicity of texts after undoing obfuscation by a noisy-channel model.

A word that was written in leetspeak, with separators, with blanks between its letters or with repeated letters is
a lattice of possible letters. Every word with two equal letters in a row is one of these too. Viterbi decoding
finds the likeliest path under a character trigram model, which is counted over all documents; between letters that
were written with blanks any place may be the edge of a word. Restored words and their first letters are then looked up in a lexicon of strong signs,
learned from labelled documents. Signs combine by noisy-or, and a logistic curve, fitted on the same documents,
turns their weight into a probability.

Only whole texts enter the score. Null text is the empty text, with the score of a text without signs. Null ids are
kept and belong to no fold; repeated rows get the same score; an empty table gives no row. Without labels of both
kinds no word is a sign and every score is the base rate.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from traceops.llm.quality import labelled_sample, scored
from traceops.llm.text import parts, picked, spread, strings, words

#: The lexicon is fitted on at most so many labelled documents, chosen by the hash of their ids.
SAMPLE = 30_000
#: At most so many signs are kept, the strongest first.
SIGNS = 50_000
#: Share of toxic documents among those with a sign, at least.
PRECISION = 0.9
#: More signs than for this weight do not make a text more toxic.
MOST_WEIGHT = 40.0
#: Signs are words, and the first letters of longer ones.
PREFIXES = (4, 5, 6)

# fixed values: letters that a written character may stand for, with the cost of each reading
_READINGS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "§": "s"}
_SEPARATORS = frozenset(".-_*~/\\'`^·•​‌‍­, ")
_READ_COST, _KEEP_COST, _DOUBLE_COST = 1.0, 9.0, 0.5

# letters as numbers: 0 the edge of a word, 1 to 26 a to z, 27 any other letter
_ACCENTS = {"a": "àáâãäå", "c": "ç", "e": "èéêë", "i": "ìíîï",
            "n": "ñ", "o": "òóôõö", "u": "ùúûü", "y": "ýÿ"}
SIZE = 28


def _numbers() -> np.ndarray:
    table = np.zeros(0x250, dtype=np.int64)
    for code in range(0x250):
        letter = chr(code).lower()
        table[code] = 27 if letter.isalpha() else 0
        if len(letter) == 1 and "a" <= letter <= "z":
            table[code] = ord(letter) - 96
    for plain, accented in _ACCENTS.items():
        for letter in accented:
            table[ord(letter)] = ord(plain) - 96
    return table


_NUMBER = _numbers()


def _letters(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, owners): letters of all values, each between two edges."""
    flat = np.frombuffer("\0\0".join(["", *values, ""]).encode("utf-32-le"), dtype=np.uint32)
    numbers = np.where(flat < len(_NUMBER), _NUMBER[np.minimum(flat, len(_NUMBER) - 1)], 27)
    owner = np.cumsum((flat[1:] == 0) & (flat[:-1] == 0)) - 1
    return numbers, np.append(-1, owner)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """How often each three letters follow each other in the words of the texts."""
    _, codes, values = words(pc.utf8_lower(texts))
    number, owner = _letters(values.to_pylist())
    weight = np.append(np.bincount(codes, minlength=len(values)), 0)
    code = (number[:-2] * SIZE + number[1:-1]) * SIZE + number[2:]
    return np.bincount(code, weights=weight[np.clip(owner[2:], -1, len(values))], minlength=SIZE ** 3)


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of the third letter after two, from all documents; SIZE cubed counts reach the driver."""

    def run(batches):
        total = np.zeros(SIZE ** 3)
        for batch in batches:
            for piece in parts(batch, "text"):
                total += trigram_counts(strings(piece.column("text")))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen].astype(np.int64))], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram BIGINT, n BIGINT").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(SIZE ** 3)
    for row in rows:
        count[row.gram] = row.n
    return log_probabilities(count)


def log_probabilities(count: np.ndarray) -> np.ndarray:
    three = count.reshape(SIZE, SIZE, SIZE)
    two = three.sum(axis=0)
    one = two.sum(axis=0) + 1.0
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    return np.log((three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5))


def lattice(word: str, edges: bool = False) -> list[list[tuple[str, float]]]:
    """For each written character or run of it, the letters it may stand for and their costs.

    With `edges` a word may end after every character; such places are blanks among the letters.
    """
    out = []
    for run in re.finditer(r"(.)\1*", word.lower(), re.S):
        char, size = run[1], len(run[0])
        if char.isalpha():
            spellings = [(char, 0.0 if size == 1 else _DOUBLE_COST)] + ([(char * 2, 0.0)] if size > 1 else [])
        elif char in _READINGS:
            spellings = [(letter * n, _READ_COST + (n - 1) * _DOUBLE_COST) for letter in _READINGS[char] for n in range(1, min(size, 2) + 1)]
            spellings.append(("", _KEEP_COST))
        else:
            spellings = [("", 0.0 if char in _SEPARATORS else _KEEP_COST)]
        if edges:
            for n in range(2, min(size, 3) + 1):
                ones = [(letters, cost) for letters, cost in spellings if len(letters) == 1]
                spellings += [(x * k + " " + x * (n - k), 0.0 if x == char else cost) for x, cost in ones for k in range(1, n)]
            if out:
                out.append([("", 0.0), (" ", 0.0)])
        out.append(spellings)
    return out


def decode(word: str, model: list, edges: bool = False) -> str:
    """The likeliest letters for a written word; `model[a][b][c]` is the log probability of c after a, b.

    With `edges` these may be several words, with blanks between them.
    """
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}  # score, (letters before, last letters)
    for spellings in lattice(word, edges):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, path) in states.items():
            for letters, cost in spellings:
                x, y, now = a, b, score - cost
                for letter in letters:
                    if letter == " ":
                        # no word is empty
                        now += model[x][y][0] if y else -math.inf
                        x = y = 0
                        continue
                    code = ord(letter)
                    z = int(_NUMBER[code]) if code < 0x250 else 27
                    now += model[x][y][z]
                    x, y = y, z
                old = after.get((x, y))
                if now > -math.inf and (old is None or now > old[0]):
                    after[x, y] = (now, (path, letters) if letters else path)
        states = after
    path = max(((score + (model[a][b][0] if b or not edges else 0.0), path) for (a, b), (score, path) in states.items()), key=lambda x: x[0])[1]
    out = []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out))


_TRAILING = re.compile(r"(?:([&%*$#!.,;:?~=])\1+|[.,;:?!\"')\]}&%*#»”…])+$")
_LEADING = re.compile(r"^[\"'(\[{.,;:?&%*#«“¡¿]+")
_DOUBLE = re.compile(r"(.)\1")
_PIECE = re.compile(r"[^\W\d_]+")


def restored(values: pa.Array, model: list) -> tuple[pa.Array, dict[int, list[str]]]:
    """(plain, more): each written word without its punctuation; for obfuscated ones also their readings."""
    plain = pc.replace_substring_regex(values, r"^\P{L}+|\P{L}+$", "")
    letters_only = pc.match_substring_regex(plain, r"^\p{L}*$").to_numpy(zero_copy_only=False)
    has_letter = pc.not_equal(plain, "").to_numpy(zero_copy_only=False)
    core = pc.replace_substring_regex(values, r"^[\"'(\[{.,;:?&%*#]+|[.,;:?\"')\]}&%*#]+$", "")
    changed = pc.not_equal(core, plain).to_numpy(zero_copy_only=False)
    text = values.to_pylist()
    flat = np.frombuffer("\0".join(["", *text, ""]).encode("utf-32-le"), dtype=np.uint32)
    double = np.flatnonzero((flat[1:] == flat[:-1]) & (flat[1:] != 0))
    repeated = np.zeros(len(text), dtype=bool)
    repeated[(np.cumsum(flat == 0) - 1)[double]] = True
    more = {}
    for i in np.flatnonzero(has_letter & (~letters_only | changed | repeated)):
        word = _LEADING.sub("", _TRAILING.sub("", text[i]))
        if word and not (word.isalpha() and not _DOUBLE.search(word)):
            more[int(i)] = list(dict.fromkeys([decode(word, model), *(x for x in _PIECE.findall(word) if len(x) > 2)]))
    return plain, more


def spaced(offsets: np.ndarray, codes: np.ndarray, values: pa.Array) -> list[tuple[int, str]]:
    """(text, letters) of each run of three or more words of one character."""
    single = (pc.utf8_length(pc.replace_substring_regex(values, r"[.,;:*_\-]+$", "")).to_numpy(zero_copy_only=False) == 1)[codes]
    edge = np.diff(np.concatenate([[0], single.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = []
    for a, b in zip(begin[end - begin > 2].tolist(), end[end - begin > 2].tolist()):
        # a run may reach over the end of a text
        for doc in range(np.searchsorted(offsets, a, "right") - 1, np.searchsorted(offsets, b, "left")):
            x, y = max(a, offsets[doc]), min(b, offsets[doc + 1])
            if y - x > 2:
                out.append((doc, "".join(values[int(c)].as_py()[0] for c in codes[x:y])))
    return out


def apart(letters: str, model: list) -> list[str]:
    """The readings of a run of spaced letters: as one word, then as several words, if these differ."""
    one, several = decode(letters, model), decode(letters, model, edges=True).split()
    return [one, *several] if several != [one] else [one]


def signs(texts: pa.Array, model: list) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(docs, signs, names): distinct pairs of a text and a word or word start in it."""
    offsets, codes, values = words(pc.utf8_lower(texts))
    plain, more = restored(values, model)
    owner = [np.arange(len(values))]
    names = [plain]
    extra = [(i, w) for i, found in more.items() for w in found]
    owner.append(np.array([i for i, _ in extra], dtype=np.int64))
    names.append(pa.array([w for _, w in extra], pa.string()))
    word, owner = pa.concat_arrays([x.cast(pa.string()) for x in names]), np.concatenate(owner)
    joined = [(d, w) for d, letters in spaced(offsets, codes, values) for w in apart(letters, model)]
    loose_words = pa.array([w for _, w in joined], pa.string())

    def starts(array):
        size = pc.utf8_length(array).to_numpy(zero_copy_only=False)
        for n in PREFIXES:
            at = np.flatnonzero(size > n)
            yield at, pc.binary_join_element_wise(pc.utf8_slice_codeunits(array.take(pa.array(at)), 0, n), "*", "")

    # numbers for all names of words
    pieces = [(owner, word)] + [(owner[at], names) for at, names in starts(word)]
    loose_doc = np.array([d for d, _ in joined], dtype=np.int64)
    loose = [(loose_doc, loose_words)] + [(loose_doc[at], names) for at, names in starts(loose_words)]
    coded = pa.concat_arrays([x.cast(pa.string()) for _, x in pieces + loose]).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    total = sum(len(x) for x, _ in pieces)
    of_value = np.concatenate([x for x, _ in pieces])
    order = np.argsort(of_value, kind="stable")
    begin = np.searchsorted(of_value[order], np.arange(len(values) + 1))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    count = np.diff(begin)[codes]
    found = number[:total][order[spread(begin[:-1][codes], count)]]
    docs = np.concatenate([np.repeat(doc, count), *[x for x, _ in loose]])
    found = np.concatenate([found, number[total:]])
    both = np.unique(docs * (len(coded.dictionary) + 1) + found)
    return both // (len(coded.dictionary) + 1), both % (len(coded.dictionary) + 1), coded.dictionary.to_pylist()


@dataclass(frozen=True)
class Lexicon:
    names: list[str]
    doubts: np.ndarray  # log of 1 - p of each sign
    model: list
    base: float = 0.0  # of the logistic curve, with its slope
    slope: float = 1.0

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * self.weight(texts), -30, 30)))

    def weight(self, texts: pa.Array) -> np.ndarray:
        """How strongly the signs of each text speak for toxicity, from 0."""
        offsets, codes, values = words(pc.utf8_lower(texts))
        plain, more = restored(values, self.model)
        known = pa.array(self.names, pa.string())
        doubts = np.append(self.doubts, 0.0)

        def doubt(array):
            best = doubts[pc.fill_null(pc.index_in(array, known), len(self.names)).to_numpy(zero_copy_only=False)]
            size = pc.utf8_length(array).to_numpy(zero_copy_only=False)
            for n in PREFIXES:
                start = pc.binary_join_element_wise(pc.utf8_slice_codeunits(array, 0, n), "*", "")
                at = pc.fill_null(pc.index_in(start, known), len(self.names)).to_numpy(zero_copy_only=False)
                best = np.where(size > n, np.minimum(best, doubts[at]), best)
            return best

        of_value = doubt(plain)
        if more:
            owner = np.array([i for i, found in more.items() for _ in found])
            np.minimum.at(of_value, owner, doubt(pa.array([w for found in more.values() for w in found], pa.string())))
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        total = np.bincount(doc, weights=of_value[codes], minlength=len(texts))
        joined = spaced(offsets, codes, values)
        if joined:
            read = [apart(letters, self.model) for _, letters in joined]
            each = doubt(pa.array([w for found in read for w in found], pa.string()))
            first = np.cumsum([0, *map(len, read)])
            # one word or several are two readings of the same letters: the stronger counts
            best = [min(each[a], each[a + 1:b].sum()) for a, b in zip(first, first[1:])]
            np.add.at(total, [d for d, _ in joined], best)
        return np.minimum(-total, MOST_WEIGHT)


def fit(rows: list[tuple[str, int, int]], toxic: int, clean: int, model: np.ndarray) -> Lexicon:
    """`rows`: (sign, toxic documents with it, clean ones with it). Keeps signs that chance doesn't explain."""
    if not toxic or not clean:
        return Lexicon([], np.zeros(0), model.tolist(), math.log((toxic + 0.5) / (clean + 0.5)))
    # copies of a document are not independent, so more is asked than the number of candidates would need
    rate, least = toxic / (toxic + clean), -2 * math.log(max(len(rows), 1)) - 1
    kept = []
    for name, bad, good in rows:
        share = bad / (bad + good)
        if share > max(PRECISION, rate):
            # log of the chance of so many toxic documents among those with the sign
            chance = -(bad + good) * (share * math.log(share / rate) + (0 if good == 0 else (1 - share) * math.log((1 - share) / (1 - rate))))
            if chance < least:
                kept.append((chance, name, (bad + rate) / (bad + good + 1)))
    kept = sorted(kept)[:SIGNS]
    return Lexicon([n for _, n, _ in kept], np.log1p(-np.array([p for _, _, p in kept], dtype=np.float64)), model.tolist())


def calibrated(lexicon: Lexicon, weight: np.ndarray, toxic: np.ndarray) -> Lexicon:
    """The lexicon with the logistic curve of these labelled weights, by Newton steps."""
    if not len(lexicon.names):
        return lexicon
    x = np.stack([np.ones(len(weight)), weight], axis=1)
    curve = np.array([-4.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        gradient = x.T @ (toxic - p) - 0.1 * (curve - [-4.0, 1.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), gradient)
        curve += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return replace(lexicon, base=float(curve[0]), slope=max(float(curve[1]), 1e-3))


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE) -> Lexicon:
    """`docs` has key and text."""
    table = model.tolist()

    def run(batches):
        for batch in batches:
            for piece in parts(batch, "text"):
                bad = piece.column("label").to_numpy(zero_copy_only=False).astype(bool)
                doc, sign, names = signs(strings(piece.column("text")), table)
                toxic = np.bincount(sign[bad[doc]], minlength=len(names))
                clean = np.bincount(sign[~bad[doc]], minlength=len(names))
                names = pa.array([*names, "\0"], pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(np.append(toxic, bad.sum())), pa.array(np.append(clean, (~bad).sum()))],
                                                 names=["sign", "toxic", "clean"])

    chosen = labelled_sample(docs, labels, "toxic", sample).select("text", "label")
    rows = chosen.mapInArrow(run, "sign STRING, toxic BIGINT, clean BIGINT")
    # a sign needs three toxic documents, so few of the sample's words come to the driver
    rows = (rows.groupBy("sign").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter("sign = '\\0' OR (toxic >= 3 AND toxic > clean AND length(sign) > 2)").collect())
    total = next((r for r in rows if r.sign == "\0"), None)
    found = sorted((r.sign, r.toxic, r.clean) for r in rows if r.sign != "\0")
    lexicon = fit(found, total.toxic if total else 0, total.clean if total else 0, model)

    def weigh(batches):
        for batch in batches:
            for piece in parts(batch, "text"):
                yield pa.RecordBatch.from_arrays([piece.column("label").cast(pa.int32()), pa.array(lexicon.weight(strings(piece.column("text"))))],
                                                 names=["label", "weight"])

    pairs = chosen.mapInArrow(weigh, "label INT, weight DOUBLE").toArrow()
    weight, bad = np.array(pairs["weight"].to_pylist(), dtype=float), np.array(pairs["label"].to_pylist(), dtype=float)
    order = np.lexsort((bad, weight))
    return calibrated(lexicon, weight[order], bad[order])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", sample=SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted (from 0.7) of every document."""
    docs = picked(docs, key=id_column, text=text_column)
    lexicon = train(docs, labels, letter_model(docs), sample)
    return scored(docs, lexicon.score, 0.7)
