"""Text quality by naive Bayes support vectors.

Binary n-gram indicators are scaled by their class log-count ratios; on them a linear model with hinge loss is fitted by
dual coordinate descent. The n-grams are those of word shapes (one and two words, with a mark where a word repeats the one
before), each at several levels of its share in the text, and levels of the text length: words themselves are not used, so
a model carries over to words and languages it has not seen. Margins become probabilities by Platt's logistic fit on a
held-out fold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import pieces, whole_texts
from orderlens.llm.linear import SAMPLE_ROWS, Sparse, collect_features, fold, labelled_sample, sigmoid
from orderlens.llm.vectext import grouped_counts, mixed, split_shapes

#: Hashed n-grams, the shares of a text that give an indicator each, and the smallest lengths that do.
NGRAMS, SHARES = 1 << 15, (0.0, 0.01, 0.03, 0.1, 0.25, 0.5)
LENGTHS = (1, 4, 8, 16, 32, 64, 128, 512, 2048)
WIDTH = NGRAMS * len(SHARES) + len(LENGTHS)
COST, EPOCHS, THRESHOLD = 0.1, 30, 0.7


def features(column: pa.Array) -> Sparse:
    """Indicators of each text: n-gram at share level, and length level. All values are 1."""
    tokens, shapes = split_shapes(column)
    doc, sizes = shapes.doc, np.diff(shapes.first)
    follows = np.zeros(len(doc), bool)
    follows[1:] = doc[1:] == doc[:-1]
    repeats = np.zeros(len(doc), bool)
    repeats[1:] = follows[1:] & (tokens.hashes[1:] == tokens.hashes[:-1])
    single = mixed(shapes.hashes + repeats.astype(np.uint64))
    double = mixed(single[1:] * np.uint64(3) + single[:-1])[follows[1:]]
    grams = np.concatenate((single, double, repeats.astype(np.uint64)))  # the last: any repeated word, hashed as 0 or 1
    where = np.concatenate((doc, doc[1:][follows[1:]], doc))
    d, gram, count = grouped_counts(where, grams & np.uint64(NGRAMS - 1), NGRAMS)
    share = count / np.maximum(sizes, 1)[d]
    found = [(d[share > s], gram[share > s] * len(SHARES) + level) for level, s in enumerate(SHARES)]
    found += [(np.flatnonzero(sizes >= n), np.full((sizes >= n).sum(), NGRAMS * len(SHARES) + level))
              for level, n in enumerate(LENGTHS)]
    rows, ids = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    order = np.lexsort((ids, rows))
    return Sparse(np.searchsorted(rows[order], np.arange(len(column) + 1)), ids[order], np.ones(len(ids)))


@dataclass
class Model:
    """weights (log-count ratios times the support vector weights), bias, and Platt's slope and offset."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, rows: Sparse) -> np.ndarray:
        return rows.dot(self.weights) + self.bias

    def probability(self, rows: Sparse) -> np.ndarray:
        return sigmoid(self.slope * self.margin(rows) + self.offset)


def log_count_ratios(rows: Sparse, good: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each indicator among good rows over that among bad ones."""
    counts = [1 + np.bincount(rows.columns, good[rows.row] == side, WIDTH) for side in (True, False)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def dual_coordinate_descent(rows: Sparse, sign: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the bias) of the linear model with hinge loss: one dual variable after the other moves to
    its best value between 0 and its cost. The order of each epoch is shuffled with a fixed seed."""
    weights, dual = np.zeros(WIDTH + 1), np.zeros(len(rows))
    at = [np.append(rows.columns[a:b], WIDTH) for a, b in zip(rows.first[:-1], rows.first[1:])]
    value = [np.append(rows.values[a:b], 1.0) for a, b in zip(rows.first[:-1], rows.first[1:])]
    square = np.array([v @ v for v in value])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = sign[i] * (weights[at[i]] @ value[i]) - 1
            new = min(max(dual[i] - gradient / square[i], 0.0), cost[i])
            if new != dual[i]:
                weights[at[i]] += (new - dual[i]) * sign[i] * value[i]
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-4:
            break
    return weights


def platt(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, with Platt's smoothed targets, by Newton steps."""
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    x = np.stack((margin, np.ones(len(margin))), axis=1)
    fitted = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ fitted)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        change = np.linalg.solve(curve, x.T @ (p - target))
        fitted = fitted - change * min(1.0, 2 / max(np.abs(change).max(), 1e-12))
        if np.abs(change).max() < 1e-8:
            break
    return float(max(fitted[0], 0.0)), float(fitted[1])


def may_learn(doc_id: Column) -> Column:
    """Rows that labels may be learned from; the others are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) != 2


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most ``rows`` labelled documents that may be learned from (bounded sample, see labelled_sample).

    Three folds of four fit the weights, the fourth the probabilities. With labels of one class only every text gets the
    smoothed share of good labels.
    """
    sample = labelled_sample(docs, labels, "quality", rows, may_learn(F.col("doc_id")))
    ids, label, x = collect_features(sample, features)
    good = label == 1
    if good.all() or not good.any():
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros(WIDTH), 0.0, 0.0, float(np.log(share / (1 - share))))
    held = fold(ids) == 0
    if min(good[held].sum(), (~good[held]).sum(), good[~held].sum(), (~good[~held]).sum()) == 0:
        held = np.zeros(len(good), bool)
    train = x.only(~held)
    ratio = log_count_ratios(train, good[~held])
    scaled = Sparse(train.first, train.columns, train.values * ratio[train.columns])
    sign = np.where(good[~held], 1.0, -1.0)
    # Both classes weigh the same in sum.
    cost = COST * np.where(good[~held], 0.5 / good[~held].mean(), 0.5 / (~good[~held]).mean())
    solved = dual_coordinate_descent(scaled, sign, cost)
    plain = Model(solved[:-1] * ratio, float(solved[-1]), 1.0, 0.0)
    checked = x.only(held) if held.any() else x
    slope, offset = platt(plain.margin(checked), good[held] if held.any() else good)
    return Model(plain.weights, plain.bias, slope, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``, from its whole text alone.

    score is the probability of a good label, predicted 1 where it is at least THRESHOLD. Null and empty texts have only the
    bias and so one fixed score; a null doc_id counts as held out (nothing can be learned from it). Repeated rows are
    scored alike; other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=1 << 19):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                              "score": shared.value.probability(features(batch.column("text")))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = whole_texts(docs).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (~F.coalesce(may_learn(F.col("doc_id")), F.lit(False))).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
