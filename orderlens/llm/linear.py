"""Sparse rows and the bounded sample of labelled documents that both linear classifiers learn from."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import hashed_sample, pieces, whole_texts

#: Labelled rows a classifier learns from at most; a parameter of both.
SAMPLE_ROWS = 6144


class Sparse:
    """A sparse matrix by rows: values at ``columns``, rows from first[r] to first[r + 1]."""

    def __init__(self, first: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.first, self.columns, self.values = first.astype(np.int64), columns.astype(np.int32), values
        self.row = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.first) - 1

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * weights[self.columns], len(self)).astype(float)

    def back(self, rows: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, self.values * rows[self.row], width).astype(float)

    def only(self, wanted: np.ndarray) -> Sparse:
        """The rows where ``wanted``."""
        keep = wanted[self.row]
        sizes = np.diff(self.first)[wanted]
        return Sparse(np.concatenate(([0], np.cumsum(sizes))), self.columns[keep], self.values[keep])

    def without(self, dropped: np.ndarray) -> Sparse:
        """All rows, less the entries in columns that are ``dropped``."""
        keep = ~dropped[self.columns]
        sizes = np.bincount(self.row[keep], minlength=len(self))
        return Sparse(np.concatenate(([0], np.cumsum(sizes))), self.columns[keep], self.values[keep])


#: Features of a text column: one row per text.
Featurizer = Callable[[pa.Array], Sparse]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, allowed: Column | None = None) -> DataFrame:
    """doc_id, label, text of at most ``rows`` labelled documents, those with the smallest hash of doc_id.

    A null label is none; of several labels of one doc_id the smallest counts, of several texts the first in order. Only
    the bounded sample is broadcast, and only its rows are shuffled.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    known = known.filter(allowed) if allowed is not None else known
    chosen = hashed_sample(known.groupBy("doc_id").agg(F.min("label").alias("label")), rows, "doc_id")
    sample = whole_texts(docs).join(F.broadcast(chosen), "doc_id")
    return sample.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def collect_features(sample: DataFrame, features: Featurizer) -> tuple[np.ndarray, np.ndarray, Sparse]:
    """doc_ids, labels and features of a bounded sample, made in the tasks and in ascending order of doc_id.

    The driver holds about nine bytes a feature: tens of MB for the largest sample.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=1 << 19):
            made = features(batch.column("text"))
            ends = pa.array(made.first.astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "columns": pa.ListArray.from_arrays(ends, pa.array(made.columns.astype(np.int32))),
                "weights": pa.ListArray.from_arrays(ends, pa.array(made.values.astype(np.float32)))})

    kind = sample.schema["doc_id"].dataType.simpleString()
    table = sample.mapInArrow(run, f"doc_id {kind}, label int, columns array<int>, weights array<float>").toArrow()
    ids, label = (table.column(c).to_numpy() for c in ("doc_id", "label"))
    sizes = np.concatenate([c.value_lengths().to_numpy() for c in table.column("columns").chunks] or [np.zeros(0, int)])
    order, starts = np.argsort(ids, kind="stable"), np.cumsum(sizes) - sizes
    place = np.repeat(starts[order] - (np.cumsum(sizes[order]) - sizes[order]), sizes[order]) + np.arange(sizes.sum())
    flat = []
    for name, kind in (("columns", np.int32), ("weights", np.float32)):
        parts = [c.flatten().to_numpy() for c in table.column(name).chunks]
        table = table.drop_columns(name)  # each column is let go before the next is copied
        flat.append(np.concatenate(parts or [np.zeros(0, kind)])[place])
    return ids[order], label[order], Sparse(np.concatenate(([0], np.cumsum(sizes[order]))), *flat)


def fold(ids: np.ndarray, folds: int = 4) -> np.ndarray:
    """A fixed fold for each id, by a multiplicative hash; ids that are no integers go by the crc32 of their text."""
    if ids.dtype.kind not in "iu":
        ids = np.array([crc32(str(i).encode()) for i in ids], np.uint64)
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(folds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))
