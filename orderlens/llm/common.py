"""What the text operators share: reading documents, stored intermediate tables, small numeric helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.session import scratch_path


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def whole_texts(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, the named extra columns and the whole text, null read as empty; all other columns are left behind."""
    return docs.select("doc_id", *extra, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there and survives lost executors."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def id_text(column: str) -> Column:
    """A nullable id as a join key that is never null: ids keep their digits, null becomes the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hashed_sample(frame: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most ``rows`` rows of ``frame``, those with the smallest hash of ``key``, which tells all rows apart.

    Only rows under a cut that a count gives are put in order: four times as many as wanted are expected there in all,
    whatever the number of partitions.
    """
    hashed = frame.withColumn("__h", F.xxhash64(*key))
    share = 4 * rows / max(frame.count(), 1)
    if share < 1:
        hashed = hashed.filter(F.col("__h") < F.lit(int(share * 2 ** 64) - 2 ** 63))
    return hashed.orderBy("__h", *key).limit(rows).drop("__h")


def numbered(rows: DataFrame, order: list[Column], group: str | None, name: str) -> DataFrame:
    """The rows with ``position`` (from 0, in ``order``, anew for every value of ``group``) and ``size`` of their group.

    Rows are dealt out by ranges of (group, order) and stored in order, so a group of any size lies over many files; what
    is added up across files is one count per file and group. ``order`` must tell all rows apart that differ.
    """
    keys = [*([F.col(group)] if group else []), *order]
    ranged = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), name)
    by = [group] if group else []
    counts = ranged.groupBy("__part", *by).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", *by, "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
                            F.sum("__n").over(whole).alias("size"))
    return (ranged.join(offsets, ["__part", *by])
            .withColumn("position", F.col("__before") + F.col("__at") - F.col("__first"))
            .drop("__part", "__at", "__first", "__before"))


#: Characters of the longest text that a cache remembers.
LONGEST = 64


class Memo(dict):
    """A cache that computes what it lacks and starts anew at ``limit`` entries. Long texts, which hardly ever come again,
    are computed each time, so its memory is bounded."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(key) > LONGEST:
            return self.compute(key)
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The Arrow batches cut into runs of rows with about ``size`` bytes in ``column``; a larger value is a run alone.

    Python workers live on after a task, so what Arrow keeps for reuse is given back at its end.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    pa.default_memory_pool().release_unused()


def int_lists(parts: list[bytes]) -> pa.ListArray:
    """Little-endian 32-bit integers, one bytes object per row, as an Arrow list column."""
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), np.int32)))
