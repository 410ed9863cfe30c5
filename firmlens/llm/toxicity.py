"""Toxicity scores: a factorization machine over hashed terms.

A text becomes the set of its lower-cased words and of their beginnings, each hashed to 32 bits.
Terms whose presence goes with the label (chi-squared over the training rows) form the vocabulary;
the machine gives each a weight and a factor vector, so that pairs of terms add what neither adds
alone.

Null and empty texts have no term and get the bias alone. Counts, lengths and repeats of a word do
not matter, and texts are read whole. An empty corpus gives an empty result; without training rows
of both labels every score is the share of label 1 (0 if there is none).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, LongType

from .common import (Scratch, bounded_batches, bounded_labels, learnable, replace_columns,
                     small_or_shuffled)

#: Lengths of the word beginnings that are terms of their own.
HEADS = (3, 4, 5, 7)
_WORD = re.compile(r"\w+")


def term_hashes(text: str | None) -> list[int]:
    """The 32-bit hashes of a text's distinct terms: lower-cased words, and their beginnings, which
    carry the stems of inflected insults."""
    words = set(_WORD.findall((text or "").lower()))
    heads = {w[:k] + "*" for w in words for k in HEADS if len(w) > k}
    return [zlib.crc32(w.encode()) for w in words] + [zlib.crc32(h.encode()) for h in heads]


@pandas_udf(ArrayType(LongType()))
def _terms(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: np.array(term_hashes(t), "i8"))


@dataclass
class FactorizationMachine:
    """score = sigmoid(bias + sum of weights + sum over pairs of <factors, factors>)."""

    terms: np.ndarray  # sorted hashes of the vocabulary
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # a row for each term

    def margins(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """rows, cols: document and vocabulary position of each present term."""
        out = self.bias + np.bincount(rows, self.weights[cols], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[cols, f]
            out += 0.5 * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return out

    def known(self, text: str | None) -> np.ndarray:
        """The vocabulary positions of a text's terms."""
        keys = np.array(term_hashes(text), "i8")
        at = np.searchsorted(self.terms, keys)
        near = at < len(self.terms)
        near[near] = self.terms[at[near]] == keys[near]
        return at[near]

    def score(self, texts) -> np.ndarray:
        found = [self.known(t) for t in texts]
        rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
        cols = np.concatenate([np.array([], "i8"), *found])
        margin = self.margins(rows, cols, len(found))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def train(terms: np.ndarray, docs: list[np.ndarray], labels: np.ndarray, rank: int = 4,
          steps: int = 2000, rate: float = 0.05, decay: float = 1e-4, batch: int = 256,
          seed: int = 5) -> FactorizationMachine:
    """`steps` Adam steps on the logistic loss. docs: vocabulary positions of each row."""
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.0
    start = np.log((share + 1e-6) / (1 - share + 1e-6))
    fm = FactorizationMachine(terms, start, np.zeros(len(terms)),
                              rng.normal(0, 0.02, (len(terms), rank)))
    if share in (0.0, 1.0) or not len(terms):
        return fm
    params = [np.array([fm.bias]), fm.weights, fm.factors]
    first, second = [p * 0 for p in params], [p * 0 for p in params]
    waiting: list[np.ndarray] = []
    for step in range(1, steps + 1):
        if not waiting:
            waiting = np.array_split(rng.permutation(len(docs)), max(1, len(docs) // batch))
        chosen = waiting.pop()
        sizes = np.array([len(docs[i]) for i in chosen])
        rows = np.repeat(np.arange(len(chosen)), sizes)
        cols = np.concatenate([docs[i] for i in chosen]).astype("i8")
        fm.bias = float(params[0][0])
        p = 1 / (1 + np.exp(-np.clip(fm.margins(rows, cols, len(chosen)), -40, 40)))
        err = (p - labels[chosen]) / len(chosen)
        grad = [np.array([err.sum()]), np.bincount(cols, err[rows], len(terms)),
                np.zeros_like(fm.factors)]
        for f in range(rank):
            v = fm.factors[cols, f]
            total = np.bincount(rows, v, len(chosen))
            grad[2][:, f] = np.bincount(cols, err[rows] * (total[rows] - v), len(terms))
        for k, g in enumerate(grad):
            g = g + decay * params[k] * (k > 0)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] -= (rate * first[k] / (1 - 0.9 ** step)
                          / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8))
    fm.bias = float(params[0][0])
    return fm


def fit(docs: DataFrame, labels: DataFrame, bound: int = 20_000, max_terms: int = 4096,
        least_chi2: float = 11.0, least_docs: int = 4, column: str = "toxic",
        **training) -> FactorizationMachine:
    """Train on at most about `bound` labelled rows (all, if fewer), `labels.column` their label.
    Spark counts terms and picks the vocabulary (at most `max_terms`, the strongest first); only
    the vocabulary and each row's positions in it come to the driver."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    docs = bounded_batches(docs)
    chosen = scratch.put(bounded_labels(labels, column, bound), "labels")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(small_or_shuffled(chosen), "doc_id")
            .select("doc_id", "label", _terms("text").alias("terms")))
    rows = scratch.put(rows, "rows")
    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    vocabulary = np.array([], "i8")
    if 0 < n1 < n:
        counts = (rows.select("label", F.explode("terms").alias("term")).groupBy("term")
                  .agg(F.count("*").alias("k"), F.sum("label").alias("a"))
                  .where(F.col("k") >= least_docs))
        k, a = F.col("k").cast("double"), F.col("a").cast("double")
        gap = a * (n / n1) - k
        chi2 = gap * gap * n * n1 / (k * (n - k) * (n - n1))
        strong = (counts.where(F.col("k") < n).select("term", chi2.alias("chi2"))
                  .where(F.col("chi2") >= least_chi2)
                  .orderBy(F.desc("chi2"), "term").limit(max_terms).collect())
        vocabulary = np.array(sorted(r["term"] for r in strong), "i8")
    wanted = F.from_json(F.lit(str(vocabulary.tolist())), "array<bigint>")
    kept = F.array_sort(F.array_intersect("terms", wanted))
    table = (rows.select("doc_id", "label", kept.alias("terms")).orderBy("doc_id", "label")
             .toArrow().combine_chunks())
    scratch.drop()
    if not table.num_rows:
        return train(vocabulary, [], np.array([]), **training)
    terms = table.column("terms").combine_chunks()
    ends = np.cumsum(pc.list_value_length(terms).to_numpy())
    positions = np.split(np.searchsorted(vocabulary, terms.flatten().to_numpy()), ends[:-1])
    return train(vocabulary, positions, table.column("label").to_numpy().astype("f8"), **training)


def score_of(text: Column, model: FactorizationMachine) -> Column:
    """The score, 0 to 1, of every whole text."""

    @pandas_udf(DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return scored(text)


def score(docs: DataFrame, model: FactorizationMachine, threshold: float = 0.5) -> DataFrame:
    """`docs` with score and predicted (1 from the threshold on)."""
    scored = replace_columns(docs, score=score_of(F.col("text"), model))
    return replace_columns(scored, predicted=(F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, bound: int = 20_000,
               threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score is below the threshold, as they were."""
    return docs.where(score_of(F.col("text"), fit(docs, labels, bound)) < threshold)


def toxic_documents(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, bound))
    return scored.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score",
                         "predicted")
