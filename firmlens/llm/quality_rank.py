"""Quality scores by Bradley-Terry ranking of preference pairs.

Each text becomes a vector of whole-text statistics. A pair of a good and a bad document says that
the good one is preferred; logistic loss on the difference of their vectors gives the document
score. A quantile of the training scores, the share of bad rows, becomes the threshold: scores are
shifted so that it maps to `at` (0.3 for the query).

Null and empty texts have the vector of a text without words. An empty corpus gives an empty
result; without training rows of both labels every score is 1 - share of bad rows (0.5 if none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from .common import (Scratch, bounded_batches, bounded_labels, learnable, replace_columns,
                     small_or_shuffled)

#: Statistics of a text.
WIDTH = 12


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text, each about between 0 and 1 or a logarithm."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * WIDTH
    distinct = set(words)
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = sum(map(text.count, "#*$%&|<>"))
    stops = sum(map(text.count, ".,;:!?"))
    digits = sum(map(text.count, "0123456789"))
    return [
        np.log1p(n), sum(map(len, words)) / n / 10, len(distinct) / n, symbols / n,
        symbols / chars, digits / chars, stops / n,
        sum(map(str.isalpha, distinct)) / len(distinct), 1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)) / 5, max(map(len, distinct)) / 50, np.log1p(len(distinct)),
    ]


@pandas_udf(ArrayType(DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


def _spread(x: np.ndarray) -> np.ndarray:
    """Standardised statistics, their squares and square roots of size: bends that a line lacks."""
    x = np.clip(x, -6, 6)
    return np.hstack([x, np.abs(x), np.minimum(x * x, 9) / 3])


@dataclass
class BradleyTerry:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float  # added to the score before the logistic function

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _spread((stats - self.centre) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(stats) + self.shift, -40, 40)))


def train(stats: np.ndarray, labels: np.ndarray, at: float = 0.3, rounds: int = 400,
          pairs: int = 4096, rate: float = 0.03, decay: float = 1e-3, seed: int = 7) -> BradleyTerry:
    """Each round draws `pairs` preference pairs (a good row over a bad one) and takes an Adam step
    on their logistic loss."""
    rng = np.random.default_rng(seed)
    width = stats.shape[1] if stats.ndim == 2 else WIDTH
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        p = np.clip(len(good) / len(labels), 1e-6, 1 - 1e-6) if len(labels) else 0.5
        return BradleyTerry(np.zeros(width), np.ones(width), np.zeros(3 * width),
                            float(np.log(p / (1 - p))))
    centre, scale = np.median(stats, 0), stats.std(0) + 1e-6
    x = _spread((stats - centre) / scale)
    w, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, rounds + 1):
        gap = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
        miss = 1 / (1 + np.exp(np.clip(gap @ w, -40, 40)))
        g = -(miss[:, None] * gap).mean(0) + decay * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= rate * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    threshold = np.quantile(x @ w, len(bad) / len(labels))
    return BradleyTerry(centre, scale, w, float(np.log(at / (1 - at)) - threshold))


def fit(docs: DataFrame, labels: DataFrame, bound: int = 20_000, column: str = "quality",
        **training) -> BradleyTerry:
    """Train on at most about `bound` labelled rows; only their statistics come to the driver."""
    scratch = Scratch(docs.sparkSession, "quality")
    docs = bounded_batches(docs)
    chosen = scratch.put(bounded_labels(labels, column, bound), "labels")
    table = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .join(small_or_shuffled(chosen), "doc_id")
             .select("doc_id", "label", _statistics("text").alias("stats"))
             .orderBy("doc_id", "stats").toPandas())
    scratch.drop()
    stats = np.array(table["stats"].tolist(), "f8").reshape(-1, WIDTH)
    return train(stats, table["label"].to_numpy("f8"), **training)


def score(docs: DataFrame, model: BradleyTerry, threshold: float = 0.3) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from the threshold on) of every whole text."""

    @pandas_udf(DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        stats = np.array([statistics(t) for t in texts], "f8").reshape(-1, WIDTH)
        return pd.Series(model.score(stats))

    scored_docs = replace_columns(docs, score=scored(F.col("text")))
    return replace_columns(scored_docs, predicted=(F.col("score") >= threshold).cast("int"))


def quality_documents(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, bound))
    return scored.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score",
                         "predicted")
