"""Quality by pairwise ranking (Bradley-Terry) of documents.

A document's strength is a linear function of its features. Weights are learned from preference pairs, a good
document over a bad one, by logistic loss on the difference of their features. The threshold is a quantile of the
strengths of the labelled sample: the share of bad documents in it. Scores are logistic in strength minus threshold.

Only whole texts enter the features. Null text is the empty text and gets a score like any other. Null ids are
kept and belong to no fold; repeated rows get the same score; an empty table gives no row. Labels that are null,
or whose document is unknown, are not used; without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from traceops.llm.text import few, folds, parts, picked, strings, words

#: The ranking is fitted on at most so many labelled documents, chosen by the hash of their ids, and on so many pairs.
SAMPLE = 20_000
PAIRS = 200_000
LEAST_SCORE = 0.5
FEATURES = ("log_words", "log_word_length", "capital_words", "title_words", "symbol_ends", "symbol_words", "digit_words",
            "distinct_words", "repeated_next", "repeated_pairs", "top_word", "letters", "symbols", "blanks",
            "sentence_ends", "long_words", "log_line_words", "vowels", "empty")


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each whole text."""
    offsets, codes, values = words(texts)
    count = np.diff(offsets)
    doc = np.repeat(np.arange(len(count)), count)
    n = np.maximum(count, 1)

    def flag(pattern):
        return pc.match_substring_regex(values, pattern).to_numpy(zero_copy_only=False).astype(np.float64)

    def share(of_value):
        return np.bincount(doc, weights=of_value[codes], minlength=len(count)) / n

    size = pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.float64)
    letters = pc.utf8_length(pc.replace_substring_regex(values, r"\P{L}", "")).to_numpy(zero_copy_only=False).astype(np.float64)
    vowels = size - pc.utf8_length(pc.replace_substring_regex(values, r"(?i)[aeiouyáàâäãéèêëíìîïóòôöõúùûü]", "")).to_numpy(zero_copy_only=False)
    chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.float64), 1)
    inked = np.maximum(np.bincount(doc, weights=size[codes], minlength=len(count)), 1)
    inked_letters = np.bincount(doc, weights=letters[codes], minlength=len(count))

    def runs(keys):
        """(distinct keys, largest count) of each document."""
        order = np.lexsort((keys[0], keys[1]))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (keys[0][order][1:] != keys[0][order][:-1]) | (keys[1][order][1:] != keys[1][order][:-1])
        at = np.flatnonzero(first)
        length, owner = np.diff(np.append(at, len(order))), keys[1][order][at]
        most = np.zeros(len(count))
        np.maximum.at(most, owner, length)
        return np.bincount(owner, minlength=len(count)), most

    distinct, most = runs((codes.astype(np.int64), doc))
    inner = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    pair = codes[inner].astype(np.int64) * (len(values) + 1) + codes[inner + 1]
    pairs, _ = runs((pair, doc[inner]))
    n_pairs = np.maximum(count - 1, 1)
    same = np.bincount(doc[inner], weights=(codes[inner] == codes[inner + 1]).astype(float), minlength=len(count))
    lines = pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False) + 1
    return np.stack([
        np.log1p(count), np.log1p(inked / n), share(flag(r"^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$")), share(flag(r"^\p{Lu}\p{Ll}")),
        share(flag(r"[^\p{L}\p{N}.,;:?'\")]$")), share(flag(r"^[^\p{L}\p{N}]+$")), share(flag(r"\p{N}")),
        distinct / n ** 0.9, same / n_pairs, 1 - pairs / n_pairs * (count > 1) - (count <= 1), most / n,
        inked_letters / chars, (inked - inked_letters) / inked, (chars - inked) / chars,
        share(flag(r"[.!?]$")), share((size > 20).astype(float)), np.log1p(count / lines),
        np.bincount(doc, weights=vowels[codes], minlength=len(count)) / np.maximum(inked_letters, 1), (count == 0).astype(float),
    ], axis=1)


@dataclass(frozen=True)
class Ranking:
    """Strength of standardised features, the threshold and the width of the logistic around it."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    width: float

    def score(self, x: np.ndarray) -> np.ndarray:
        strength = _expanded((x - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip((strength - self.threshold) / self.width, -30, 30)))


def _expanded(z: np.ndarray) -> np.ndarray:
    """Features with their squares, held within bounds so that no odd text leaves the scale."""
    z = np.clip(z, -8, 8)
    return np.concatenate([z, z * z / 8], axis=1)


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, penalty: float = 1e-3) -> Ranking:
    """Bradley-Terry weights by Newton steps on the logistic loss of feature differences."""
    if not good.any() or good.all():
        return Ranking(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(2 * x.shape[1]), 0.0, 1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = _expanded((x - mean) / scale)
    random = np.random.default_rng(7)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    difference = z[random.choice(better, pairs)] - z[random.choice(worse, pairs)]
    weights = np.zeros(z.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
        gradient = difference.T @ (1 - p) / pairs - penalty * weights
        curvature = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + penalty * np.eye(len(weights))
        step = np.linalg.solve(curvature, gradient)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    strength = z @ weights
    threshold = float(np.quantile(strength, (~good).mean()))
    width = max(float(np.median(strength[good]) - threshold) / 3, 1e-6)
    return Ranking(mean, scale, weights, threshold, width)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """key, text, label of at most `sample` labelled documents outside the held-out fold."""
    rows = (picked(labels, key="doc_id", label=label).filter("key IS NOT NULL AND label IS NOT NULL").filter(folds(F.col("key")) != 1)
            .groupBy("key").agg(F.min("label").alias("label")))
    return docs.join(F.broadcast(few(rows, F.col("key"), sample)), "key")  # `sample` rows of two numbers


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking:
    """`docs` has key and text."""

    def run(batches):
        for batch in batches:
            for piece in parts(batch, "text"):
                x = features(strings(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("label").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))],
                                                 names=["label", "x"])

    rows = labelled_sample(docs, labels, "quality", sample).select("text", "label").mapInArrow(run, "label INT, x ARRAY<DOUBLE>").toArrow()
    x = np.array(rows["x"].to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    good = np.array(rows["label"].to_pylist(), dtype=bool)
    order = np.lexsort((*x.T, good))
    return fit(x[order], good[order])


def score_quality(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", sample=SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = picked(docs, key=id_column, text=text_column)
    ranking = train(docs, labels, sample)
    return scored(docs, lambda texts: ranking.score(features(texts)), LEAST_SCORE)


def good_documents(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", sample=SAMPLE) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text the ranking does not reject."""
    ranking = train(picked(docs, key=id_column, text=text_column), labels, sample)

    def run(batches):
        for batch in batches:
            for piece in parts(batch, text_column):
                good = ranking.score(features(strings(piece.column(text_column)))) >= LEAST_SCORE
                yield piece.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def scored(docs: DataFrame, score, least: float) -> DataFrame:
    """doc_id, held_out, score, predicted by a function of whole texts."""

    def run(batches):
        for batch in batches:
            for piece in parts(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(score(strings(piece.column("text"))), pa.float64())], names=["key", "score"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(run, f"key {kind}, score DOUBLE").select(
        F.col("key").alias("doc_id"), F.coalesce(folds(F.col("key")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= least).cast("int").alias("predicted"))
