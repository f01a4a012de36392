"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(severity >= j | x) = sigmoid(w.x - t_j) with one weight vector for all thresholds t_1 < t_2 < t_3; the score is the
expected severity, the sum of these. Features are hashed words and word beginnings, valued by the square root of their
share in the text. The labels are yes or no, so grades are made of them: a toxic text is grade 1, 2 or 3 by the tertile of
its share of words that the labels tie to toxic texts. Fitting minimises the negative log likelihood with an L1 penalty
by accelerated proximal gradient steps on a bounded sample; the cut between clean and toxic is set on a held-out fold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import pieces, whole_texts
from orderlens.llm.linear import SAMPLE_ROWS, Sparse, collect_features, fold, labelled_sample, sigmoid
from orderlens.llm.vectext import grouped_counts, split_words

#: Hashed features; word beginnings of this many bytes count beside the words; grades over zero.
WIDTH, STEMS, GRADES = 1 << 18, (5, 7), 3
#: Feature scale, L1 penalty, gradient steps, fewest texts and least z-score of a feature that is learned.
SCALE, PENALTY, STEPS, RARE, TELLING = 10.0, 5e-3, 200, 3, 2.0


def features(column: pa.Array) -> Sparse:
    """Hashed words and word beginnings of each text, SCALE times the square root of their share among its words."""
    docs, ids, counts, sizes = [], [], [], None
    for at, longest in enumerate((None, *STEMS)):
        words = split_words(column, longest)
        hashed = (words.hashes >> np.uint64(20 + at)) & np.uint64(WIDTH - 1)
        d, f, c = grouped_counts(words.doc, hashed, WIDTH)
        docs.append(d), ids.append(f), counts.append(c)
        sizes = np.diff(words.first)
    doc = np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    doc, feature, count = doc[order], np.concatenate(ids)[order], np.concatenate(counts)[order]
    values = SCALE * np.sqrt(count / np.maximum(sizes, 1)[doc])
    return Sparse(np.searchsorted(doc, np.arange(len(column) + 1)), feature, values)


@dataclass
class Model:
    """weights over the hashed features, ascending thresholds, and the expected severity from which a text is toxic."""

    weights: np.ndarray
    thresholds: np.ndarray
    cut: float

    def severity(self, rows: Sparse) -> np.ndarray:
        margin = rows.dot(self.weights)
        return sigmoid(margin[:, None] - self.thresholds).sum(axis=1)


def grades(rows: Sparse, toxic: np.ndarray) -> np.ndarray:
    """0 for clean texts; 1 to GRADES for toxic ones by the weight of features that occur mostly in toxic texts."""
    seen = [np.bincount(rows.columns, toxic[rows.row] == side, WIDTH) + 0.5 for side in (True, False)]
    odds = np.log(seen[0] / (toxic.sum() + 1)) - np.log(seen[1] / ((~toxic).sum() + 1))
    strength = rows.dot(((odds > 2) & (seen[0] > RARE)).astype(float))
    cuts = np.quantile(strength[toxic], [k / GRADES for k in range(1, GRADES)]) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(cuts, strength, side="right"), 0)


def telling(rows: Sparse, toxic: np.ndarray) -> np.ndarray:
    """Features in enough texts whose share among toxic and clean texts differs by TELLING standard errors."""
    hits = [np.bincount(rows.columns, toxic[rows.row] == side, WIDTH) for side in (True, False)]
    sizes = [max(toxic.sum(), 1), max((~toxic).sum(), 1)]
    pooled = (hits[0] + hits[1] + 1) / (sum(sizes) + 2)
    error = np.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]))
    return (hits[0] + hits[1] >= RARE) & (np.abs(hits[0] / sizes[0] - hits[1] / sizes[1]) >= TELLING * error)


def fit_ordinal(rows: Sparse, grade: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple:
    """Weights and ascending thresholds. Columns are scaled to one length, so rare features learn as fast as common."""
    known = telling(rows, grade > 0)
    length = np.sqrt(np.bincount(rows.columns, rows.values ** 2, WIDTH))
    scale = np.where(known, 1 / np.maximum(length, 1e-12), 0.0) * np.sqrt(len(rows))
    x = rows.without(~known)
    x.values = x.values * scale[x.columns]
    share = [(np.sum(grade >= j) + 0.5) / (len(grade) + 1) for j in range(1, GRADES + 1)]
    thresholds = np.log([(1 - s) / s for s in share])
    thresholds = np.maximum.accumulate(thresholds + np.arange(GRADES) * 1e-3)
    probe = np.ones(WIDTH) * known  # largest curvature of the loss, by power iteration
    for _ in range(20):
        probe = x.back(x.dot(probe), WIDTH)
        largest = max(np.linalg.norm(probe), 1e-12)
        probe /= largest
    step = 1 / (0.5 * largest / len(x) + 0.5)
    w, ahead, momentum = np.zeros(WIDTH), np.zeros(WIDTH), 1.0
    for _ in range(steps):
        margin = x.dot(ahead)
        edges = np.concatenate(([-np.inf], thresholds, [np.inf]))
        above, beyond = sigmoid(margin - edges[grade]), sigmoid(margin - edges[grade + 1])
        inside = np.maximum(above - beyond, 1e-12)
        slope = (above + beyond - 1) / len(x)
        moved = ahead - step * x.back(slope, WIDTH)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead, w, momentum = new + (momentum - 1) / following * (new - w), new, following
        lower = np.bincount(grade, above * (1 - above) / inside, GRADES + 1)[1:]
        upper = np.bincount(grade + 1, beyond * (1 - beyond) / inside, GRADES + 2)[1:GRADES + 1]
        thresholds = thresholds - step * (lower - upper) / len(x)
        thresholds = np.maximum.accumulate(thresholds + np.arange(GRADES) * 1e-6)
    return w * scale, thresholds


def best_cut(severity: np.ndarray, toxic: np.ndarray) -> float:
    """The severity from which calling a text toxic gives the best F1; midway between neighbours, lowest on ties."""
    if not toxic.any():
        return float(GRADES)
    order = np.argsort(-severity, kind="stable")
    hits = np.cumsum(toxic[order])
    score = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    last = len(order) - 1 - int(np.argmax(score[::-1]))
    following = severity[order[last + 1]] if last + 1 < len(order) else 0.0
    return float((severity[order[last]] + following) / 2)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most ``rows`` labelled documents (bounded sample, see labelled_sample). One fold of four sets the
    cut. With no labelled toxic document nothing is toxic."""
    ids, label, x = collect_features(labelled_sample(docs, labels, "toxic", rows), features)
    x = x.without(np.bincount(x.columns, minlength=WIDTH) < RARE)  # most features; they could not be learned anyway
    toxic = label == 1
    if not toxic.any() or toxic.all():
        return Model(np.zeros(WIDTH), np.arange(GRADES) + 20.0, float(GRADES))
    grade = grades(x, toxic)
    held = fold(ids) == 0
    weights, thresholds = fit_ordinal(x.only(~held), grade[~held])
    trial = Model(weights, thresholds, 0.0)
    enough = toxic[held].sum() >= 5
    cut = best_cut(trial.severity(x.only(held) if enough else x), toxic[held] if enough else toxic)
    return Model(weights, thresholds, cut)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (0 to GRADES, expected), toxic: one row per row of ``docs``, from its whole text.

    Null and empty texts have no features and so the severity of an unremarkable text. Repeated rows and null doc_ids are
    scored like any other; other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=1 << 19):
            severity = shared.value.severity(features(batch.column("text")))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "severity": severity,
                                              "toxic": severity >= shared.value.cut})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole_texts(docs).mapInArrow(run, f"doc_id {kind}, severity double, toxic boolean")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not toxic; scored on the fly, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=1 << 19):
            severity = shared.value.severity(features(batch.column("text")))
            yield batch.filter(pa.array(severity < shared.value.cut))

    return docs.mapInArrow(run, docs.schema)
