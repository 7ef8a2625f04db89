"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Every feature has a weight and a short vector; two features interact by the
product of their vectors. The sum over all pairs is half of (the square of the
sum of the scaled vectors less the sum of their squares), which takes time
linear in the number of features of a text.

Features are the words of the text (hashed, by the root of their frequency,
scaled to length 1), shares that describe its structure, and the metadata
columns named in META by their logarithm.

The model is fitted in one task on at most MOST_ROWS labelled texts and has a
fixed size. Every text is scored whole, in one pass without a shuffle.

Defined results: null and empty texts have no words and zero structure; missing
or negative metadata counts as 0; scoring looks at neither id, source nor
language, so repeated rows and null ids get equal scores; without labels of both
kinds every score is the share of good labels (0.5 without any); an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.labelled import remainder, training_rows
from tripwire.llm.text_arrays import fold, texts, word_hashes

BITS = 14
RANK = 6
META = ("n_chars",)
MOST_ROWS = 8000
FOLDS, HELD_OUT = 3, 1

# Byte classes whose shares describe a text's structure.
CLASSES = tuple(np.isin(np.arange(256), np.frombuffer(c, np.uint8)) for c in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".,;:", b"\n", b"{}[]()=_/\\+~^@"))
STATS = len(CLASSES) + 6


def structure(data: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares between 0 and about 1."""
    out = np.zeros(STATS)
    if len(words):
        histogram = np.bincount(data, minlength=256)
        out[:len(CLASSES)] = [min(1.0, 4 * histogram[c].sum() / len(data)) for c in CLASSES]
        pairs = words[:-1] * np.uint64(3) + words[1:]
        out[len(CLASSES):] = [
            np.log1p(len(words)) / 10, min(len(data) / len(words) / 20, 2.0), len(counts) / len(words),
            counts.max() / len(words), 1 - len(np.unique(pairs)) / max(len(pairs), 1), len(words) < 10]
    return out


def features(data: np.ndarray, meta: list[float | None]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features; structure and metadata come after the words."""
    words = word_hashes(fold(data))
    kinds, counts = np.unique(words, return_counts=True)
    hashed, at = np.unique((kinds >> np.uint64(64 - BITS)).astype(np.int64), return_inverse=True)
    value = np.sqrt(np.bincount(at, counts, len(hashed))) if len(hashed) else np.zeros(0)
    value /= max(np.sqrt((value ** 2).sum()), 1e-12)
    more = [np.log1p(max(m, 0)) / 10 if m is not None and m == m else 0.0 for m in meta]
    dense = np.append(structure(data, words, counts), more)
    return np.append(hashed, (1 << BITS) + np.arange(len(dense))), np.append(value, dense)


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def odds(self, at: np.ndarray, value: np.ndarray) -> float:
        scaled = self.vectors[at] * value[:, None]
        return float(self.bias + self.weights[at] @ value + 0.5 * ((scaled.sum(0) ** 2).sum() - (scaled ** 2).sum()))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, epochs: int = 30,
          batch: int = 200) -> Machine:
    """Adaptive gradient steps over batches in a fixed order."""
    rng = np.random.Generator(np.random.PCG64(7))
    n_good = int((labels == 1).sum())
    share = (n_good + 0.5) / (len(labels) + 1)
    bias, w, v = float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, RANK))
    if n_good in (0, len(labels)):
        return Machine(bias, w, np.zeros_like(v))
    square_w, square_v, square_b = np.full(size, 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            at = np.concatenate([rows[i][0] for i in chosen])
            x = np.concatenate([rows[i][1] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            scaled = v[at] * x[:, None]
            sums = np.stack([np.bincount(row, scaled[:, f], len(chosen)) for f in range(RANK)], 1)
            squares = np.bincount(row, (scaled ** 2).sum(1), len(chosen))
            odds = bias + np.bincount(row, w[at] * x, len(chosen)) + 0.5 * ((sums ** 2).sum(1) - squares)
            error = (_sigmoid(odds) - labels[chosen]) / len(chosen)
            by_word = error[row] * x
            kinds, place = np.unique(at, return_inverse=True)
            g_w = np.bincount(place, by_word, len(kinds)) + 1e-5 * w[kinds]
            parts = by_word[:, None] * (sums[row] - scaled)
            g_v = np.stack([np.bincount(place, parts[:, f], len(kinds)) for f in range(RANK)], 1) + 1e-5 * v[kinds]
            square_w[kinds] += g_w ** 2
            square_v[kinds] += g_v ** 2
            square_b += error.sum() ** 2
            w[kinds] -= 0.1 * g_w / np.sqrt(square_w[kinds])
            v[kinds] -= 0.05 * g_v / np.sqrt(square_v[kinds])
            bias -= 0.1 * error.sum() / np.sqrt(square_b)
    return Machine(bias, w, v)


def _features_of(batch: pa.RecordBatch, meta: tuple[str, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    columns = [batch.column(m).to_pylist() for m in meta]
    for i, data in enumerate(texts(batch.column("text"))):
        yield features(data, [c[i] for c in columns])


def fit(docs: DataFrame, labels: DataFrame, meta: tuple[str, ...] = META, most: int = MOST_ROWS) -> Machine:
    size = (1 << BITS) + STATS + len(meta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, marks = [], []
        for batch in batches:
            rows += _features_of(batch, meta)
            marks += batch.column("label").to_pylist()
        machine = train(rows, np.array(marks, int), size)
        yield pa.RecordBatch.from_pydict({
            "bias": [machine.bias], "weights": [machine.weights.astype("<f8").tobytes()],
            "vectors": [machine.vectors.astype("<f8").tobytes()]})

    sample = training_rows(_with_meta(docs, meta), labels, "quality", FOLDS, HELD_OUT, most, meta)
    row = sample.select("text", "label", *meta).coalesce(1).mapInArrow(run, "bias double, weights binary, vectors binary").first()
    if row is None:
        return train([], np.zeros(0, int), size)
    return Machine(row["bias"], np.frombuffer(row["weights"], "<f8"), np.frombuffer(row["vectors"], "<f8").reshape(size, RANK))


def _with_meta(docs: DataFrame, meta: tuple[str, ...]) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string"), *[F.col(m).cast("double").alias(m) for m in meta])


def score(docs: DataFrame, machine: Machine, meta: tuple[str, ...] = META) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)`` and the metadata."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [float(_sigmoid(machine.odds(*f))) for f in _features_of(batch, meta)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = _with_meta(docs, meta).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
