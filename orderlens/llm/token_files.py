"""Token ids in ORC files: run-length encoded integers, row indexes and Bloom filters on document ids.

Documents are dealt out by ranges of doc_id and written in ascending order, so the files follow each other and the stripes
of a file too. A row holds doc_id, its ids and the number of ids before it in its file; a table of file totals gives the
place of each file in the whole. Readers split files at stripes, skip stripes and row groups by the minimum, maximum and
Bloom filter of doc_id, and need no order of tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.byte_tokens import with_end
from orderlens.llm.common import stored, whole_texts

#: Writer settings: bytes of a stripe, rows of an index entry, Bloom filter on the document ids.
ORC = {"compression": "none", "orc.stripe.size": str(16 << 20), "orc.create.index": "true",
       "orc.row.index.stride": "2000", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 0) -> None:
    """Encodes every row's whole text, appends ``end_id`` and writes doc_id, first, ids in ascending doc_id.

    Null text counts as empty and yields the end id alone. Null doc_ids come first; rows with one doc_id are in a
    fixed order that depends on their texts. Other columns are ignored. An empty table gives a folder without rows. path: a byte-level tokenizer
    file that every executor can read.
    """
    # The hash spreads rows that share a doc_id; the texts themselves would travel to the driver as range samples.
    texts = whole_texts(docs).withColumn("h", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    with_end(ordered, path, end_id).write.options(**ORC).orc(folder)


def read_tokens(spark: SparkSession, folder: str, kind: str = "bigint") -> DataFrame:
    """doc_id, first, ids as written, and part, the file. A filter on doc_id is pushed to stripes and row groups."""
    rows = spark.read.schema(f"doc_id {kind}, first bigint, ids array<int>").orc(folder)
    return rows.select("*", F.col("_metadata.file_name").alias("part"))


def file_number(part: Column) -> Column:
    """The number in the name of a file that Spark wrote."""
    return F.regexp_extract(part, r"part-([0-9]+)", 1).cast("bigint")


def token_index(tokens: DataFrame) -> DataFrame:
    """doc_id, start (ids of all rows before), n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            sums = [zlib.crc32(data[4 * a: 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("first"),
                 pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
                names=["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    rows = stored(tokens.mapInArrow(run, f"doc_id {kind}, part string, first bigint, n_tokens bigint, ids_crc32 bigint"),
                  "token-index")
    # One row per file, so the window below orders as many rows as there are files. Names pad the number of a file to five
    # digits only, so files go by that number.
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy(file_number(F.col("part")), "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens",
                                           "ids_crc32")
