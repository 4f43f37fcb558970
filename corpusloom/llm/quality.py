"""Operator 4, quality classifier: positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents that a label marks as good; unlabelled examples are any documents outside the
held-out fold; labels of bad documents are never read. A first classifier of positives against unlabelled text gives the class
prior: over its upper quantiles, on the half of the examples it was not fitted to, the smallest ratio of the unlabelled to the positive
share (less its standard error) bounds the share of good documents in unlabelled text. The scorer then minimises
``prior * loss(P, +) + max(0, loss(U, -) - prior * loss(P, -))``, and turns back on examples for which the second part went
below zero. Features are raw byte pairs of the whole text and its share of symbols, capitals, digits and repeated words.

Limits: ``positives`` and ``unlabelled`` bound the examples, drawn by a hash of their ids. Examples are whole texts of any
length, of several of an id the one with the smallest hash; every document is scored whole.

Defined cases: null and empty texts get the score of a text without features; a null id is not held out and no example; labels that are null
or of unknown documents are not used; repeated rows get equal scores; without positives every score is 0.5; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import held_out
from corpusloom.llm.grams import Features, Grams, descend, fit_logistic, joined, linear, presence, select, shape, sigmoid, text_pieces
from corpusloom.llm.training import fitted, texts_of, training_ids

PAIRS = Grams(2, False)


@dataclass
class QualityModel:
    features: Features
    weights: np.ndarray
    prior: float

    def matrix(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.hstack([self.features.matrix(data, at), shape(data, at)])

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return sigmoid(linear(self.matrix(data, at), self.weights))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The smallest ratio of upper-tail shares over the quantiles 0.05 to 0.75 of the positives' scores.

    Each ratio counts less its standard error: a prior that is too large leaves no room for negatives.
    """
    low = 1.0
    for c in np.quantile(positive, np.linspace(0.05, 0.75, 15)):
        p, u = max((positive >= c).mean(), 1e-9), max((unlabelled >= c).mean(), 1e-9)
        low = min(low, u / p * (1 - np.sqrt((1 - u) / (u * len(unlabelled)) + (1 - p) / (p * len(positive)))))
    return float(np.clip(low, 0.05, 0.98))


def risk_gradient(xp: np.ndarray, xu: np.ndarray, prior: float, l2: float):
    """The gradient of the non-negative unbiased risk with the logistic loss."""

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = xp @ w, xu @ w
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        down = xu.T @ sigmoid(zu) / len(xu) - prior * (xp.T @ sigmoid(zp)) / len(xp)
        g = down - prior * (xp.T @ sigmoid(-zp)) / len(xp) if negative >= 0 else -down
        g[:-1] += l2 * w[:-1]
        return g

    return gradient


def fit(positive: list[str], unlabelled: list[str], width: int = 256, seed: int = 4) -> QualityModel | None:
    if not positive or not unlabelled:
        return None
    data, at = joined([*positive, *unlabelled])
    y = np.r_[np.ones(len(positive)), np.zeros(len(unlabelled))]
    codes, rows = presence(PAIRS, data, at)
    model = QualityModel(Features(PAIRS, select(codes, rows, y, np.ones(len(y), bool), width)), np.zeros(0), 0.5)
    x = model.matrix(data, at)
    half = np.random.default_rng(seed).random(len(y)) < 0.5
    if all((half & (y == k)).any() and (~half & (y == k)).any() for k in (0, 1)):
        first = fit_logistic(x[half], y[half], rounds=200, l2=1e-2)
        other = linear(x[~half], first)
        model.prior = class_prior(other[y[~half] == 1], other[y[~half] == 0])
    x = np.hstack([x, np.ones((len(x), 1))])
    model.weights = descend(risk_gradient(x[y == 1], x[y == 0], model.prior, 1e-4), x.shape[1], 300, 0.05)
    return model


def trained(docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 6000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel | None:
    """Fit on a bounded draw of positives and of unlabelled documents."""
    good = training_ids(labels, id_col, F.col(label_col) == 1, positives, 41)
    any_ = training_ids(docs, id_col, F.lit(True), unlabelled, 42)
    roles = good.withColumn("good", F.lit(1)).unionByName(any_.withColumn("good", F.lit(0))).groupBy("drawn_id").agg(F.max("good").alias("p"), F.min("good").alias("u"))

    def fit_rows(rows: pa.Table) -> QualityModel | None:
        own = list(zip(*(rows[name].to_pylist() for name in ("text", "p", "u")), strict=True))
        return fit([t for t, p, _ in own if p == 1], [t for t, _, u in own if u == 0])

    return fitted(texts_of(docs, roles, id_col, text_col), fit_rows)


def score_quality(docs: DataFrame, model: QualityModel | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    rows = docs.select(docs[id_col].alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in text_pieces(batches, "text"):
            s = np.full(batch.num_rows, 0.5) if model is None else model.score(data, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
