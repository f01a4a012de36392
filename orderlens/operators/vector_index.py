"""Exact top-k cosine search that skips what the triangle inequality excludes.

An index keeps unit vectors by *cell*: the nearest of a few pivots, which are vectors of the table themselves. Within a cell
the vectors lie in order of their distance to the pivot, cut into blocks; a small table has the distance range of each
block. A question q with distances d(q, p) to all pivots knows without reading a vector:

* its k-th nearest vector is not farther than its k-th nearest pivot;
* a vector v of the cell of p is at least |d(q, p) - d(v, p)| away, and at least (d(q, p) - d(q, p'))/2 for any pivot p',
  since v is nearer to p than to p'.

Cells are folders and blocks are ranges of a sorted column, so cells and row groups without a possible answer are never
read. Questions travel to the vectors in a broadcast whose size is checked; the vectors are not shuffled. More questions
than that go through ``retrieval.top_k``, which gives the same rows; what the bounds exclude is then counted in slices.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import retrieval

#: Pivots, vectors of a block at least, blocks in all (the table of blocks stays that small).
PIVOTS, BLOCK_ROWS, BLOCKS = 32, 1024, 16384
#: Similarities are compared to 12 decimals; a distance of nearly 0 is then exact to this.
SLACK = 4e-6


@dataclass(frozen=True)
class VectorIndex:
    """Where the index is stored, its pivots as unit vectors with their ids, and its table of blocks (cell, block, lo, hi,
    rows)."""

    vectors: DataFrame
    blocks: DataFrame
    pivot_ids: np.ndarray
    pivots: np.ndarray


def pivot_order(id_column: str) -> Column:
    """Pivots are the vectors that come first in this order, the same in any engine."""
    return F.md5(F.col(id_column).cast("string"))


def _first_by_hash(vectors: DataFrame, n: int) -> list[Row]:
    """The ``n`` rows first in pivot order. Only rows under a cut that a count gives are put in order, so what a partition
    sends does not add up with the number of partitions."""
    total = vectors.count()
    ordered = vectors.withColumn("_o", pivot_order("id"))
    if total > 8 * n:  # eight times as many as wanted are expected under the cut
        digits = f"{int(min(1.0, 8 * n / total) * (16 ** 13 - 1)):013x}"
        ordered = ordered.filter(F.substring("_o", 1, 13) <= digits)
    return ordered.orderBy("_o", "id").limit(n).collect()


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Straight distance between unit vectors, all with all."""
    return np.sqrt(np.maximum(2 - 2 * (left @ right.T), 0))


def build_index(vectors: DataFrame, folder: str, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> VectorIndex:
    """The stored index of ``vectors`` (id, embedding; ids are unique) under ``folder``, a new folder.

    Vectors that are null or zero, or hold a null or NaN, are never found, so they are not kept.
    """
    spark = vectors.sparkSession
    vector = vectors.schema[1].dataType.simpleString()
    known = vectors.toDF("id", "embedding").select(F.col("id").cast("bigint"), "embedding").filter("embedding IS NOT NULL")
    chosen = [(r["id"], r["embedding"]) for r in _first_by_hash(known, pivots) if _usable(r["embedding"])]
    spark.createDataFrame([(n, *r) for n, r in enumerate(chosen)], f"cell int, id bigint, embedding {vector}").coalesce(
        1).write.parquet(f"{folder}/pivots")
    centres = _pivots(chosen)[1]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = retrieval._columns(batch, "id", "embedding")[1]
                good = ~np.isnan(units).any(axis=1)
                if not good.any():
                    continue
                far, batch = distances(units[good], centres), batch.filter(pa.array(good))
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), batch.column("id"),
                     pa.array(far[np.arange(len(cell)), cell].astype(np.float32)), batch.column("embedding")],
                    names=["cell", "id", "d", "embedding"])

    schema = f"cell int, id bigint, d float, embedding {vector}"

    placed = known.mapInArrow(assign, schema)
    in_order = placed.repartitionByRange("cell", "d", "id").sortWithinPartitions("cell", "d", "id")
    size = known.agg(F.count("*")).scalar()
    rows_each = F.greatest(F.lit(block_rows), F.ceil(size / F.lit(BLOCKS))).cast("bigint")
    number = F.monotonically_increasing_id()  # the partition in the high bits, the place in it in the low ones
    blocked = in_order.withColumn("block", number - F.pmod(number.bitwiseAND(F.lit((1 << 33) - 1)), rows_each))
    blocked.write.partitionBy("cell").parquet(f"{folder}/vectors")
    stored = spark.read.schema(blocked.schema).parquet(f"{folder}/vectors")
    blocks = stored.groupBy("cell", "block").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count("*").alias("rows"))
    blocks.write.parquet(f"{folder}/blocks")
    return VectorIndex(stored, spark.read.schema(blocks.schema).parquet(f"{folder}/blocks"), *_pivots(chosen))


def open_index(spark: SparkSession, folder: str) -> VectorIndex:
    """An index that was built before."""
    chosen = spark.read.parquet(f"{folder}/pivots").orderBy("cell").select("id", "embedding").collect()  # PIVOTS rows
    return VectorIndex(spark.read.parquet(f"{folder}/vectors"), spark.read.parquet(f"{folder}/blocks"), *_pivots(chosen))


def _usable(embedding: list) -> bool:
    return any(embedding) and all(x is not None and x == x for x in embedding)


def _pivots(chosen: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors; a table without any usable vector has one pivot that is near to nothing."""
    if not chosen:
        return np.array([-1]), np.zeros((1, 1))
    return np.array([i for i, _ in chosen]), retrieval._unit(np.array([e for _, e in chosen]))


class Questions:
    """Ids, unit vectors, distances to the pivots and, per question, how far its k-th nearest vector is at most."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, index: VectorIndex, k: int, others: bool):
        self.ids, self.vectors, self.k, self.others = ids, vectors, k, others
        self.far = distances(vectors, index.pivots)
        self.gap = (self.far - self.far.min(axis=1, keepdims=True)) / 2  # least distance to the vectors of each cell
        known = np.where(ids[:, None] == index.pivot_ids[None, :], np.inf, self.far) if others else self.far
        self.most = (np.sort(known, axis=1)[:, k - 1] if known.shape[1] >= k else np.full(len(ids), np.inf)) + SLACK

    def may_hold(self, cell: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which question may have an answer at these distances from the cell's pivot: questions by ranges."""
        far = self.far[:, cell, None]
        ring = np.maximum(far - hi[None, :], lo[None, :] - far)
        return (ring <= self.most[:, None]) & (self.gap[:, cell] <= self.most)[:, None]


def needed_blocks(index: VectorIndex, questions: Questions, blocks: pa.Table) -> pa.Table:
    """The rows of the table of blocks that may hold an answer to any question."""
    keep = np.zeros(len(blocks), bool)
    cells = blocks.column("cell").to_numpy()
    for cell in np.unique(cells):
        of = np.flatnonzero(cells == cell)
        lo, hi = (blocks.column(c).to_numpy()[of].astype(np.float64) for c in ("lo", "hi"))
        keep[of] = questions.may_hold(cell, lo, hi).any(axis=0)
    return blocks.filter(pa.array(keep))


FOUND = "query_id bigint, vector_id bigint, similarity double, pairs_left bigint"


def _scan(index: VectorIndex, queries: DataFrame, k: int, others: bool) -> tuple[DataFrame, Broadcast]:
    """The best of every task for every question, and a row per task with the number of pairs the bounds left; with it the
    broadcast of the questions, which are those of a slice."""
    asked = retrieval.questions(queries)
    spark = queries.sparkSession
    blocks = index.blocks.toArrow().combine_chunks()  # BLOCKS rows at most, but for the rounding up in cells and files
    if not len(asked[0]) or not len(blocks):  # nothing can be found; widths then need not agree
        asked = np.empty(0, np.int64), np.empty((0, index.pivots.shape[1]))
    questions = Questions(*asked, index, k, others)
    needed = needed_blocks(index, questions, blocks)
    shared = spark.sparkContext.broadcast(questions)
    cells = sorted(set(needed.column("cell").to_pylist()))
    read = index.vectors.filter(F.col("cell").isin(cells) & F.col("block").isin(needed.column("block").to_pylist()))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, left = shared.value, 0
        best = retrieval._Best(q.ids, q.vectors, q.k, q.others)
        for batch in batches:
            cell, d = batch.column("cell").to_numpy(), batch.column("d").to_numpy().astype(np.float64)
            ids, vectors = retrieval._columns(batch, "id", "embedding")
            for c in np.unique(cell):
                whole, rows = np.flatnonzero(cell == c), max(1, retrieval.BLOCK // max(1, len(q.ids)))
                for at in range(0, len(whole), rows):  # a few vectors at a time where questions are many
                    of = whole[at:at + rows]
                    may = q.may_hold(c, d[of], d[of])
                    left += int(may.sum())
                    best.add(ids[of], vectors[of], may)
        found = best.batch()
        yield found.append_column("pairs_left", pa.nulls(len(found), pa.int64()))
        yield pa.RecordBatch.from_pydict({"query_id": pa.nulls(1, pa.int64()), "vector_id": pa.nulls(1, pa.int64()),
                                          "similarity": pa.nulls(1, pa.float64()), "pairs_left": pa.array([left])})

    return read.select("cell", "d", "id", "embedding").mapInArrow(search, FOUND), shared


def top_k(index: VectorIndex, queries: DataFrame, k: int = retrieval.TOP_K, exclude_self: bool = False,
          broadcast_bytes: int = retrieval.BROADCAST_BYTES) -> DataFrame:
    """(query_id, rank, vector_id, similarity), the rows of ``retrieval.top_k`` over the indexed vectors."""
    count, size = retrieval.question_sizes(queries)
    if count * size > broadcast_bytes:
        return retrieval.top_k(queries, index.vectors.select("id", "embedding"), k, exclude_self)
    found = _scan(index, queries, k, exclude_self)[0]
    return retrieval.ranked(found.filter("vector_id IS NOT NULL"), k)


def pruning(index: VectorIndex, queries: DataFrame, k: int = retrieval.TOP_K, exclude_self: bool = False,
            broadcast_bytes: int = retrieval.BROADCAST_BYTES) -> DataFrame:
    """What the bounds save: (questions, vectors, pairs, pairs_left), the last the pairs that had to be looked at. They are
    counted for every question, however many there are; more than ``broadcast_bytes`` of them in slices."""
    asked = queries.toDF("query_id", "query").filter("query IS NOT NULL AND exists(query, x -> x <> 0)")
    counts = [asked.agg(F.count("*")).scalar(), index.blocks.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()]
    slices, left = retrieval.question_slices(queries, broadcast_bytes, broadcast_bytes), F.coalesce(F.sum("pairs_left"), F.lit(0))
    if len(slices) == 1:
        totals = _scan(index, slices[0], k, exclude_self)[0].agg(left.alias("pairs_left"))
    else:
        looked_at = 0
        for part in slices:
            found, shared = _scan(index, part, k, exclude_self)
            looked_at += found.agg(left).first()[0]
            shared.destroy()
        totals = queries.sparkSession.range(1).select(F.lit(looked_at).cast("bigint").alias("pairs_left"))
    return totals.select(counts[0].alias("questions"), counts[1].alias("vectors"), (counts[0] * counts[1]).alias("pairs"),
                         "pairs_left")
