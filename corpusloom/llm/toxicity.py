"""Operator 2, toxicity: a classifier chain over the label categories.

Categories are predicted in order. Each has a logistic model on the letter n-grams that tell most of it, and the later
ones also see the probabilities of the categories before. While fitting, those probabilities come from models that were fitted without the fold the
document is in, so that a later model learns how far an honest earlier prediction can be trusted; in use
they come from the model fitted to all examples. Labels of the held-out fold (``common.held_out``) are never read. The chain is generic in its categories; the label table at hand has
two, text that is degraded (quality 0) and text that is toxic.

Limits: ``each`` bounds the examples of either value of each category, drawn by a hash of their ids; scores so hold at
about even odds. Examples are whole texts of any length; every document is scored whole.

Defined cases: null and empty texts get the score of a text without features; null labels are no examples of their
category; a category with one value only is predicted with its share; of several texts of an id one is the example, by its hash; repeated rows get equal scores; an empty table gives
an empty result; other columns are kept by ``without_toxic`` and not read by ``score_toxicity``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import pieces, text_buffer
from corpusloom.llm.grams import Features, Grams, fit_logistic, joined, linear, presence, select, sigmoid, text_pieces
from corpusloom.llm.training import fitted, texts_of, training_ids

#: The chain: name, column of the label table, value that counts as 1.
CATEGORIES = (("degraded", "quality", 0), ("toxic", "toxic", 1))
STEMS = Grams(5, True)


@dataclass
class Link:
    features: Features
    weights: np.ndarray


@dataclass
class Chain:
    links: list[Link] = field(default_factory=list)

    def probabilities(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One column for each category, in chain order."""
        before: list[np.ndarray] = []
        for link in self.links:
            x = np.column_stack([link.features.matrix(data, at), *before])
            before.append(sigmoid(linear(x, link.weights)))
        return np.column_stack(before)


def _fit_link(codes: np.ndarray, rows: np.ndarray, data: np.ndarray, at: np.ndarray, y: np.ndarray, use: np.ndarray, before: list[np.ndarray], width: int) -> Link:
    seen = y[use]
    if len(seen) == 0 or seen.min() == seen.max():
        share = (seen.sum() + 0.5) / (len(seen) + 1)
        return Link(Features(STEMS, np.zeros(0, np.int64)), np.r_[np.zeros(len(before)), np.log(share / (1 - share))])
    features = Features(STEMS, select(codes, rows, y, use, width))
    return Link(features, fit_logistic(_matrix(features, data, at, before, use), seen))


def _matrix(features: Features, data: np.ndarray, at: np.ndarray, before: list[np.ndarray], use: np.ndarray) -> np.ndarray:
    """Features and earlier probabilities of the rows in use; only these are worked out, a part of the texts at a time."""
    rows = np.flatnonzero(use)
    out = np.zeros((len(rows), len(features.chosen) + len(before)))
    for lo in range(0, len(rows), 256):
        some = rows[lo : lo + 256]
        text = np.concatenate([data[at[r] : at[r + 1]] for r in some])
        out[lo : lo + 256, : len(features.chosen)] = features.matrix(text, np.concatenate([[0], np.cumsum(at[some + 1] - at[some])]))
    for k, column in enumerate(before):
        out[:, len(features.chosen) + k] = column[rows]
    return out


def fit_chain(texts: list[str | None], labels: np.ndarray, folds: int = 3, width: int = 512) -> Chain:
    """``labels``: a row for each text, a column for each category; NaN where unknown."""
    data, at = joined(texts)
    codes, rows = presence(STEMS, data, at)
    fold = np.arange(len(texts)) % folds
    chain, before = Chain(), []
    for k in range(labels.shape[1]):
        known = ~np.isnan(labels[:, k])
        y = np.nan_to_num(labels[:, k])
        chain.links.append(_fit_link(codes, rows, data, at, y, known, before, width))
        if k + 1 < labels.shape[1]:
            out = np.zeros(len(texts))
            for f in range(folds):
                link = _fit_link(codes, rows, data, at, y, known & (fold != f), before, width)
                out[fold == f] = sigmoid(linear(_matrix(link.features, data, at, before, fold == f), link.weights))
            before.append(out)
    return chain


def trained(docs: DataFrame, labels: DataFrame, each: int = 1500, id_col: str = "doc_id", text_col: str = "text", categories=CATEGORIES) -> Chain:
    """Fit the chain on a bounded draw of labelled documents."""
    flags = [(F.col(c) == v).cast("int").alias(f"y{k}") for k, (_, c, v) in enumerate(categories)]
    known = labels.select(F.col(id_col).alias("drawn_id"), *flags)
    ids = [training_ids(known, "drawn_id", F.col(f"y{k}") == v, each, 20 + k) for k in range(len(flags)) for v in (0, 1)]
    ids = reduce(DataFrame.union, ids).distinct()
    marked = known.join(F.broadcast(ids), "drawn_id").groupBy("drawn_id").agg(*(F.max(f"y{k}").alias(f"y{k}") for k in range(len(flags))))
    names = [f"y{k}" for k in range(len(flags))]

    def fit(rows: pa.Table) -> Chain:
        y = np.array([[np.nan if v is None else v for v in rows[name].to_pylist()] for name in names], float).reshape(len(names), -1).T
        return fit_chain(rows["text"].to_pylist(), y)

    return fitted(texts_of(docs, marked, id_col, text_col), fit) or fit_chain([], np.zeros((0, len(names))))


def score_toxicity(docs: DataFrame, chain: Chain, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", categories=CATEGORIES) -> DataFrame:
    """``doc_id``, the probability ``p_<category>`` of each category, and whether the last one reaches the threshold."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = [f"p_{name}" for name, *_ in categories]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in text_pieces(batches, "text"):
            p = chain.probabilities(data, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in p.T), pa.array(p[:, -1] >= threshold)], ["doc_id", *names, "is_toxic"])

    return rows.mapInArrow(score, f"doc_id {kind}, {', '.join(f'{n} double' for n in names)}, is_toxic boolean")


def without_toxic(docs: DataFrame, chain: Chain, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents whose last category stays below the threshold, all columns kept; one narrow pass."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, batch_name):
            p = chain.probabilities(*text_buffer(batch.column(place)))
            yield batch.filter(pa.array(p[:, -1] < threshold))

    batch_name = text_col
    return docs.mapInArrow(keep, docs.schema)
