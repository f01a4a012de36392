"""Nearest neighbours by cosine as a block matrix join over int8 codes.

1. Every vector becomes a unit vector, and that int8 codes with a scale of their own; the length of what the codes miss is
   kept beside them. For unit vectors u and v with codes' vectors u' and v', |u.v - u'.v'| <= |u - u'| + |u'| |v - v'|.
2. Rows are dealt into blocks of a fixed number of bytes. Every block of queries meets every block of vectors in one task.
3. There the codes are multiplied tile by tile. Products of at most ``EXACT_DIMS`` codes add up exactly in single
   precision, where a matrix product is fastest; longer vectors are cut. A pair survives if the product plus its error
   bound reaches the k-th best cosine that its query is sure of.
4. Survivors are computed anew in double precision from the original vectors, and enter a heap of k per query. The blocks'
   heaps are merged by rank.

Of equal vectors in a block only the k + 1 smallest ids can be among anyone's k nearest, so a vector with any number of
copies costs a block k + 1 rows. The rest is exact at every size: no caps, no buckets.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import stored

NEAREST, EVERY = 5, 50
#: Bytes of a block, as doubles; blocks of vectors are smaller where there would be too few of them for all tasks.
BLOCK_BYTES, SMALL_BYTES = 1 << 25, 1 << 20
#: Codes whose products add up below 2 ** 24, products held at once, and what single precision may be off.
EXACT_DIMS, TILE, SLACK = 1024, 1 << 21, 2e-5
FOUND = "query long, query_id {kind}, candidate long, vec_id {kind}, score double"


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The rows times a power of two that brings their largest component near 1, so that squares neither over- nor
    underflow; this changes no digit of a cosine."""
    most = np.abs(vectors).max(axis=1, initial=0.0)
    return np.ldexp(vectors, -np.frexp(most)[1][:, None])


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``left`` and the same row of ``right``, summed up component by component in order, so that the
    result does not depend on which rows are computed together."""
    dot, a, b = (np.zeros(len(left)) for _ in range(3))
    for x, y in zip(left.T, right.T):
        dot += x * y
        a += x * x
        b += y * y
    return np.clip(dot / np.sqrt(a * b), -1.0, 1.0)


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, step, length of the codes' vector and length of what it misses, for each row of scaled vectors."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    step = np.abs(unit).max(axis=1, initial=0.0) / 127
    coded = np.rint(unit / step[:, None])
    close = coded * step[:, None]
    return coded.astype(np.int8), step, np.sqrt((close * close).sum(axis=1)), np.sqrt(((unit - close) ** 2).sum(axis=1))


def usable(rows: DataFrame) -> DataFrame:
    """row, vec_id, vector: the vectors that take part, as doubles; each row of the table has a number of its own."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    vectors = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
            row = np.repeat(np.arange(len(sizes)), sizes)
            bad = np.bincount(row[~np.isfinite(flat)], minlength=len(sizes))
            size = np.bincount(row, np.nan_to_num(flat, nan=0, posinf=0, neginf=0) != 0, len(sizes))
            yield batch.filter(pa.array((bad == 0) & (size > 0)))

    good = vectors.mapInArrow(check, f"vec_id {kind}, vector array<double>")
    return good.withColumns({"row": F.monotonically_increasing_id(), "dims": F.size("vector")})


class Block:
    """The rows of a block: numbers, ids and scaled vectors, in order of id, null last."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        self.ids, self.rows = rows.column("vec_id"), rows.column("row").to_numpy()
        flat = rows.column("vector").combine_chunks().flatten().to_numpy()
        self.vectors = scaled(flat.reshape(len(self.rows), -1))
        self.codes, self.step, self.length, self.missed = codes(self.vectors)

    def firsts(self, of_each: int) -> np.ndarray:
        """Places of the rows, at most ``of_each`` of equal vectors, those with the smallest ids."""
        whole = np.ascontiguousarray(self.vectors + 0.0).view(np.dtype((np.void, self.vectors.shape[1] * 8))).ravel()
        order = np.argsort(whole, kind="stable")
        new = np.append(True, whole[order][1:] != whole[order][:-1])
        start = np.flatnonzero(new)[np.cumsum(new) - 1]
        return np.sort(order[np.arange(len(order)) - start < of_each])


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The exact products of int8 rows, as single precision where that holds them."""
    parts = [left[:, at:at + EXACT_DIMS].astype(np.float32) @ right[:, at:at + EXACT_DIMS].T.astype(np.float32)
             for at in range(0, left.shape[1], EXACT_DIMS)]
    return parts[0] if len(parts) == 1 else np.sum(parts, axis=0, dtype=np.float64)


def search(queries: Block, vectors: Block, k: int) -> list[list[tuple[float, int, int]]]:
    """For each query a heap of its k nearest as (score, -place, -query): places are in order of id."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in queries.rows]
    sure = np.full(len(heaps), -np.inf)  # cosine that k candidates of the query reach
    places = vectors.firsts(k + 1)
    wide = max(k, TILE // max(1, min(len(heaps), TILE // 512)))
    high = max(1, TILE // wide)
    for at in range(0, len(places), wide):
        part = places[at:at + wide]
        for top in range(0, len(heaps), high):
            q = slice(top, top + high)
            close = product(queries.codes[q], vectors.codes[part])
            close = close * queries.step[q, None] * vectors.step[part]
            off = queries.missed[q, None] + queries.length[q, None] * vectors.missed[part] + SLACK
            close[queries.rows[q, None] == vectors.rows[part]] = -np.inf
            if len(part) > k:
                least = -np.partition(off - close, k - 1, axis=1)[:, k - 1]  # k-th largest lower bound
                np.maximum(sure[q], least, out=sure[q])
            ask, found = np.nonzero((close + off >= sure[q, None]) & (close > -np.inf))
            for n in range(0, len(ask), TILE // 64):
                _add(heaps, sure, queries, vectors, ask[n:n + TILE // 64] + top, part[found[n:n + TILE // 64]], k)
    return heaps


def _add(heaps: list, sure: np.ndarray, queries: Block, vectors: Block, ask: np.ndarray, found: np.ndarray, k: int) -> None:
    """The exact cosines of these pairs into the heaps; ``sure`` rises with them."""
    score = cosines(queries.vectors[ask], vectors.vectors[found])
    order = np.lexsort((found, -score, ask))
    ask, found, score = ask[order], found[order], score[order]
    new = np.append(True, ask[1:] != ask[:-1])
    best = np.arange(len(ask)) - np.flatnonzero(new)[np.cumsum(new) - 1] < k
    for q, place, value in zip(ask[best].tolist(), found[best].tolist(), score[best].tolist()):
        if len(heaps[q]) < k:
            heapq.heappush(heaps[q], (value, -place))
        else:
            heapq.heappushpop(heaps[q], (value, -place))
        if len(heaps[q]) == k:
            sure[q] = max(sure[q], heaps[q][0][0])


def nearest(rows: DataFrame, is_query: Column, k: int = NEAREST, block_bytes: int = BLOCK_BYTES,
            small_bytes: int = SMALL_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``rows`` (vec_id, embedding) where ``is_query`` holds the k rows with
    the largest cosine, its own row left out; all there are if fewer.

    Vectors that are null, empty or zero, or hold a null or non-finite component, are neither queries nor candidates. Only
    vectors of equal length are compared. Equal scores are ranked by vec_id, null last. Rows count as rows: a repeated row
    is a candidate for its copy, and each query row has ranks of its own. Other columns are ignored; an empty table gives
    an empty result.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    table = stored(usable(rows), "vectors")
    queries = table.filter(is_query)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = table.groupBy("dims").agg(F.count("*").alias("rows"), F.count_if(is_query).alias("asked"))

    def blocks(count: str) -> Column:  # twice as many as fit exactly: hashing is uneven
        return F.ceil(2 * 8 * F.col(count) * F.col("dims") / F.lit(block_bytes))

    small = F.least(F.lit(tasks), F.ceil(8 * F.col("rows") * F.col("dims") / F.lit(small_bytes)))
    sizes = stored(sizes.select("dims", blocks("asked").alias("q_blocks"), F.greatest(blocks("rows"), small).alias("v_blocks")),
                   "sizes")

    def dealt(frame: DataFrame, mine: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{other}_blocks")))
        return (frame.join(sizes.filter("q_blocks > 0"), "dims")
                .withColumns({mine: F.pmod(F.xxhash64("row"), F.col(f"{mine}_blocks")) + 1, other: every})
                .select("dims", "q", "v", "row", "vec_id", "vector"))

    def renamed(frame: DataFrame) -> DataFrame:  # both sides come from one table; its columns must not be the same
        return frame.toDF(*[f"asked_{c}" for c in frame.columns])

    def meet(asked: pa.Table, candidates: pa.Table) -> pa.Table:
        asked, found = asked.rename_columns([c.removeprefix("asked_") for c in asked.column_names]), []
        if asked.num_rows and candidates.num_rows:
            left, right = Block(asked), Block(candidates)
            heaps = search(left, right, k)
            found = [(q, -place, score) for q, heap in enumerate(heaps) for score, place in heap]
        ask, place, score = zip(*found) if found else ((), (), ())
        if not found:
            return pa.table({"query": pa.array([], pa.int64()), "query_id": asked.column("vec_id").slice(0, 0),
                             "candidate": pa.array([], pa.int64()), "vec_id": candidates.column("vec_id").slice(0, 0),
                             "score": pa.array([], pa.float64())})
        return pa.table({"query": left.rows[list(ask)], "query_id": left.ids.take(pa.array(ask)),
                         "candidate": right.rows[list(place)], "vec_id": right.ids.take(pa.array(place)), "score": score})

    keys = ["dims", "q", "v"]
    met = (renamed(dealt(queries, "q", "v")).groupBy(*[f"asked_{c}" for c in keys])
           .cogroup(dealt(table, "v", "q").groupBy(*keys)).applyInArrow(meet, FOUND.format(kind=kind)))
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "candidate")
    return (met.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
