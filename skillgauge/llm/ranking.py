"""Document quality by Bradley-Terry ranking of preference pairs.

Each pair of a good and a bad labelled text is a preference. The chance that one
text beats another is the logistic function of the difference of their scores, and a
score is linear in features of the text; so weights come from logistic loss on
feature differences. A quantile of the sample's scores is the threshold.

Defined cases: a null or empty text has the features of no characters; labels that
are null or contradict each other teach nothing; without both kinds of labels every
score is 0.5.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
PAIRS = 60_000
ROUNDS = 300
PENALTY = 1e-4
SEED = 7
ACCEPT = 0.3

UPPER = string.ascii_uppercase.encode()
DIGITS = string.digits.encode()
ASCII = bytes(range(128))
OTHER_UPPER = re.compile("[À-Þ]")


def features(text: str) -> list[float]:
    """Densities of character kinds, and how much words and lines repeat."""
    data = text.encode()
    n = max(len(text), 1)
    words, lines = text.split(), text.split("\n")
    upper = len(data) - len(data.translate(None, UPPER)) + len(OTHER_UPPER.findall(text))
    digits = len(data) - len(data.translate(None, DIGITS))
    foreign = len(data.translate(None, ASCII))
    kinds = [upper / n, digits / n, foreign / n, text.count(" ") / n, text.count("\n") / n]
    shape = [
        np.log1p(len(text)),
        len(text) / max(len(words), 1) / 10,
        len(set(words)) / max(len(words), 1),
        len(set(lines)) / len(lines),
        max(map(len, words), default=0) / n,
    ]
    marks = [text.count(c) / n for c in string.punctuation]
    return [*np.sqrt(kinds), *shape, *np.sqrt(marks)]


@dataclass(frozen=True)
class Ranker:
    """Linear score; ``level`` is the score at which a text is just accepted."""

    mean: np.ndarray
    weights: np.ndarray
    level: float
    accept: float = ACCEPT

    def score(self, matrix: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(matrix), 0.5)
        raw = (matrix - self.mean) @ self.weights - self.level
        return 1 / (1 + np.exp(-np.clip(raw + np.log(self.accept / (1 - self.accept)), -30, 30)))


def fit_pairs(matrix: np.ndarray, good: np.ndarray) -> Ranker:
    """Weights from random pairs of a good and a bad row, level from a quantile."""
    width = matrix.shape[1]
    if good.all() or not good.any():
        return Ranker(np.zeros(width), np.zeros(width), 0.0)
    mean, spread = matrix.mean(axis=0), matrix.std(axis=0)
    scaled = (matrix - mean) / np.where(spread > 1e-9, spread, 1)
    rng = np.random.default_rng(SEED)
    ups, downs = np.flatnonzero(good), np.flatnonzero(~good)
    gaps = scaled[rng.choice(ups, PAIRS)] - scaled[rng.choice(downs, PAIRS)]
    weights, speed = np.zeros(width), np.zeros(width)
    for _ in range(ROUNDS):
        lost = 1 / (1 + np.exp(np.clip(gaps @ weights, -30, 30)))
        gradient = PENALTY * weights - gaps.T @ lost / len(gaps)
        speed = 0.9 * speed - 0.1 * gradient
        weights = weights + speed
    scores = scaled @ weights
    # The share of bad texts says which quantile parts the two kinds.
    place = int(round((~good).sum()))
    ordered = np.sort(scores)
    level = (ordered[place - 1] + ordered[min(place, len(ordered) - 1)]) / 2
    return Ranker(mean, weights / np.where(spread > 1e-9, spread, 1), float(level))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Ranker:
    """Fits on at most ``sample`` labelled texts outside the held-out fold."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .select("doc_id", "quality")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch.column(1)], ["features", "quality"]
            )

    joined = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    found = joined.select("text", F.col("quality").cast("int").alias("quality")).mapInArrow(
        rows, "features array<double>, quality int"
    )
    # Copies of a labelled row may make the join larger than the sample.
    table = found.limit(2 * sample).toArrow()
    if not table.num_rows:
        width = len(features(""))
        return Ranker(np.zeros(width), np.zeros(width), 0.0)
    order = sorted(zip(table["features"].to_pylist(), table["quality"].to_pylist(), strict=True))
    matrix = np.array([f for f, _ in order])
    return fit_pairs(matrix, np.array([q for _, q in order]) == 1)


def scored(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """All columns of ``docs`` and ``__score``; each text is scored where it lies."""

    @F.pandas_udf("double")
    def score(texts):
        matrix = np.array([features(t or "") for t in texts])
        return texts.__class__(ranker.score(matrix) if len(matrix) else [], dtype="float64")

    return docs.withColumn("__score", score(F.col("text")))
