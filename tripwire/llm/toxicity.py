"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A feature is whether a hashed n-gram of characters occurs in the text; its value
is the log of the ratio between its smoothed shares among toxic and other
texts. A logistic regression is trained on these values.

The model is fitted in one task on at most MOST_ROWS labelled texts and has at
most FEATURES weights; only those reach the driver. Every text is scored whole,
in one pass over the documents without a shuffle.

Defined results: null and empty texts hold no n-gram and get the bias alone;
scoring looks at the text only, so repeated rows and null ids get equal scores;
without labels of both kinds every score is the share of toxic labels (0.5
without any); an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.labelled import remainder, training_rows
from tripwire.llm.text_arrays import PIECE, texts

SIZES = (3, 4, 5, 6)
BITS = 18
FEATURES = 6000
MOST_ROWS = 8000
FOLDS, HELD_OUT = 5, 0

_ODD = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


class NgramSet:
    """The hashed n-grams of a text, by a table that is cleared after each use."""

    def __init__(self) -> None:
        self.seen = np.zeros(1 << BITS, bool)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        text = " " + " ".join(bytes(data).decode("utf-8", "replace").lower().split()) + " "
        code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        for at in range(0, len(code), PIECE):
            part = code[at:at + PIECE + max(SIZES) - 1].astype(np.uint64)
            sums = part * _ODD[0]
            for n in range(2, min(max(SIZES), len(part)) + 1):
                sums = sums[:-1] + part[n - 1:] * _ODD[n - 1]
                if n in SIZES:
                    self.seen[((sums + np.uint64(n)) * _ODD[6]) >> np.uint64(64 - BITS)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray
    weights: np.ndarray
    bias: float


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(rows: list[np.ndarray], labels: np.ndarray, features: int = FEATURES, steps: int = 300) -> ToxicityModel:
    """Log-count ratios, the features that differ most between the classes, and their regression weights."""
    ngrams, n = NgramSet(), np.array([np.sum(labels == 0), np.sum(labels == 1)])
    nothing = np.zeros(0, np.int64)
    if not n.all():
        share = (n[1] + 0.5) / (n.sum() + 1) if n.sum() else 0.5
        return ToxicityModel(nothing, nothing.astype(float), float(np.log(share / (1 - share))))
    counts = np.zeros((2, 1 << BITS))
    for data, label in zip(rows, labels, strict=True):
        counts[label, ngrams(data)] += 1
    ratio = np.log((counts[1] + 1) / (n[1] + 2)) - np.log((counts[0] + 1) / (n[0] + 2))
    share = (counts.sum(0) + 1) / (n.sum() + 2)
    apart = np.abs(counts[1] / n[1] - counts[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n).sum())
    apart[counts.sum(0) < 5] = 0
    order = np.lexsort((np.arange(len(apart)), -apart))[:features]
    chosen = np.sort(order[apart[order] > 0])
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    found = [p[p >= 0] for p in (place[ngrams(data)] for data in rows)]
    column, row = np.concatenate([*found, nothing]), np.repeat(np.arange(len(found)), [len(p) for p in found])
    value = ratio[chosen][column]

    # Regression with a small ridge, by full-batch steps with momentum and a scale for each weight.
    w, bias = np.zeros(len(chosen)), float(np.log(n[1] / n[0]))
    mean, square = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        error = _sigmoid(np.bincount(row, value * w[column], len(rows)) + bias) - labels
        gradient = np.append(np.bincount(column, value * error[row], len(chosen)) / len(rows) + 1e-4 * w, error.mean())
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient ** 2
        move = 0.03 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - float(move[-1])
    return ToxicityModel(chosen, w * ratio[chosen], bias)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> ToxicityModel:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, marks = [], []
        for batch in batches:
            rows += [d.copy() for d in texts(batch.column("text"))]
            marks += batch.column("label").to_pylist()
        model = train(rows, np.array(marks, int))
        yield pa.RecordBatch.from_pydict(
            {"features": [model.features.tolist()], "weights": [model.weights.tolist()], "bias": [model.bias]})

    sample = training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, most).select("text", "label").coalesce(1)
    row = sample.mapInArrow(run, "features array<long>, weights array<double>, bias double").first()
    if row is None:
        return train([], np.zeros(0, int))
    return ToxicityModel(np.array(row["features"], int), np.array(row["weights"], float), row["bias"])


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams, weights = NgramSet(), np.zeros(1 << BITS)
        weights[model.features] = model.weights
        for batch in batches:
            scores = [float(_sigmoid(weights[ngrams(data)].sum() + model.bias)) for data in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
