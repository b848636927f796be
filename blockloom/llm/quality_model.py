"""A quality score by regularised quadratic discriminant analysis.

Every text becomes a row of transformed statistics. Spark sums, for either class, the
rows and their products over all labelled rows to learn from; the driver gets these
sums alone, a few hundred numbers whatever the input. A class covariance is shrunk
towards the pooled variances, so that a statistic that never varies in one class has
a width. The Cholesky factor of each is inverted once and sent with the scoring
tasks: a text's Mahalanobis distance is then one product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.labels import fold, one_label
from blockloom.llm.shared import in_batches, settle, texts

_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))

FEATURES = (
    "words",
    "word_length",
    "capitals",
    "symbols",
    "separators",
    "exclamations",
    "stutter",
    "variety",
    "digits",
    "sentence_marks",
    "lines",
    "short_words",
)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a text: logarithms of sizes, roots of shares."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)

    def count(chars: bytes) -> int:
        return len(text) - len(text.translate(None, chars))

    solid = len(text) - count(_SPACE)
    letters = max(1, count(_LETTERS))
    return [
        math.log1p(n),
        math.log(solid / n),
        math.sqrt(count(_UPPER) / letters),
        math.sqrt(count(b"#*$%&<>^~=_{}[]\\@") / solid),
        math.sqrt(count(b"|") / n),
        math.sqrt(count(b"!") / n),
        math.sqrt(sum(map(eq, words, words[1:])) / n),
        math.log1p(len(set(words))) / math.log1p(n),
        math.sqrt(count(_DIGITS) / solid),
        math.sqrt(count(b".?:;,") / n),
        math.sqrt(count(b"\n") / n),
        math.sqrt(sum(1 for w in words if len(w) < 4) / n),
    ]


def featurise(docs: DataFrame) -> DataFrame:
    """doc_id and features, an array of doubles, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([statistics(t) for t in texts(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), made], ["doc_id", "features"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").transform(in_batches(run, f"doc_id {kind}, features array<double>"))


class Discriminant:
    """Two Gaussians with their own covariances.

    ``sums[c]`` has, for class c, the number of rows, the sum of rows and the sum of
    their outer products. Without rows of both classes the score is the same for all:
    the share of class 1, one more row of either class assumed.
    """

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = 0.1):
        counts = [sums[c][0] if c in sums else 0.0 for c in (0, 1)]
        self.prior = (counts[1] + 1) / (sum(counts) + 2)
        self.parts = []
        if min(counts) < 1:
            return
        k = len(sums[0][1])
        means = [sums[c][1] / counts[c] for c in (0, 1)]
        own = [sums[c][2] / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)]
        pooled = sum(counts[c] * np.diag(own[c]) for c in (0, 1)) / sum(counts)
        between = (means[0] - means[1]) ** 2
        target = np.diag(np.maximum(pooled, 0) + 1e-3 * between + 1e-6)
        for c in (0, 1):
            # Few rows say little about a covariance: they are shrunk further.
            weight = shrinkage + (1 - shrinkage) * (k + 1) / (k + 1 + counts[c])
            factor = np.linalg.cholesky((1 - weight) * own[c] + weight * target)
            inverse = np.linalg.inv(factor)
            self.parts.append((means[c], inverse, np.log(np.diag(factor)).sum()))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of class 1 for every row."""
        odds = np.full(len(rows), math.log(self.prior / (1 - self.prior)))
        for sign, part in zip((-1, 1), self.parts):
            mean, inverse, log_root = part
            distance = (((rows - mean) @ inverse.T) ** 2).sum(axis=1)
            odds += sign * (-0.5 * distance - log_root)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(labelled: DataFrame, shrinkage: float = 0.1) -> Discriminant:
    """Learn from a frame with label and features; every row counts."""
    k = len(FEATURES)
    x = [F.col("features")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rows = (
        labelled.groupBy("label")
        .agg(F.count("*"), *(F.sum(v) for v in x), *(F.sum(x[i] * x[j]) for i, j in pairs))
        .filter("label IN (0, 1)")
        .collect()
    )
    sums = {}
    for row in rows:
        products = np.zeros((k, k))
        for (i, j), value in zip(pairs, row[2 + k :]):
            products[i, j] = products[j, i] = value
        sums[row[0]] = (float(row[1]), np.array(row[2 : 2 + k]), products)
    return Discriminant(sums, shrinkage)


def quality(docs: DataFrame, labels: DataFrame, shrinkage: float = 0.1) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out and score, from 0 to 1.

    The score is the probability of ``labels.quality`` = 1. Only rows outside fold 0
    are learned from, and only their texts. NULL, empty and blank texts have zeros
    for statistics and a score as any other. Of several labels of a document the
    greatest counts; labels of no document, and NULL ones, are ignored. Repeated rows
    are all learned from and all returned; other columns are dropped.
    """
    rows = settle(featurise(docs))
    known = rows.filter(fold("doc_id") != 0).join(one_label(labels, "quality"), "doc_id")
    model = fit(known, shrinkage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(model.score(flat))],
                ["doc_id", "held_out", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.withColumn("held_out", fold("doc_id") == 0).transform(in_batches(
        run, f"doc_id {kind}, held_out boolean, score double"
    ))
