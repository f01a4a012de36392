"""Exact length histogram of encoded documents; suffix sums answer every context limit.

Documents are counted by encoded length (partial counts before the shuffle), so all that follows works on the histogram:
one row per distinct length, of which there are at most as many as the longest document has tokens. Suffix sums are taken
in two levels, over buckets of lengths and inside a bucket, so no task sorts the whole histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.byte_tokens import counts
from orderlens.llm.common import stored

#: Lengths in one bucket of the two-level sums.
BUCKET = 256


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, documents: how many rows have each length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("documents"))


def suffix_sums(counted: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """For every length L of the histogram: documents of length L, longer ones, and what a limit of L keeps.

    n_tokens, documents, longer_documents (length over L), longer_tokens (their tokens), total_tokens (of all documents),
    truncated_tokens (sum of min(length, L), what a context of L holds), share_within (documents of length up to L).
    For a limit between two lengths a < L < b of the histogram the truncated total is that of a plus (L - a) times the
    longer documents of a, so the rows answer every limit (see ``truncated_total``).
    """
    rows = counted.withColumn("bucket", F.floor(F.col("n_tokens") / bucket))
    tokens = F.col("n_tokens") * F.col("documents")
    sums = rows.groupBy("bucket").agg(F.sum("documents").alias("d"), F.sum(tokens).alias("t"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.select("bucket", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("later_documents"),
                         F.coalesce(F.sum("t").over(after), F.lit(0)).alias("later_tokens"))
    inside = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = (rows.join(totals, "bucket")
              .withColumn("longer_documents", F.col("later_documents")
                          + F.coalesce(F.sum("documents").over(inside), F.lit(0)))
              .withColumn("longer_tokens", F.col("later_tokens") + F.coalesce(F.sum(tokens).over(inside), F.lit(0))))
    whole = counted.agg(F.struct(F.sum(tokens).alias("tokens"), F.sum("documents").alias("documents"))).scalar()
    return longer.select("n_tokens", "documents", "longer_documents", "longer_tokens",
                         whole["tokens"].alias("total_tokens"),
                         (whole["tokens"] - F.col("longer_tokens") + F.col("n_tokens") * F.col("longer_documents"))
                         .alias("truncated_tokens"),
                         ((whole["documents"] - F.col("longer_documents")) / whole["documents"]).alias("share_within"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row, n_tokens: the smallest length within which at least ``share`` of the documents lie; none if empty."""
    return sums.filter(F.col("share_within") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row, tokens: the sum of min(length, limit) over all documents, for any limit; null if there are none."""
    below = F.max(F.when(F.col("n_tokens") <= limit, F.struct(
        "n_tokens", (F.col("truncated_tokens") + (limit - F.col("n_tokens")) * F.col("longer_documents")).alias("t"))))
    every = F.max(limit * (F.col("documents") + F.col("longer_documents")))
    return sums.agg(F.coalesce(below["t"], every).alias("tokens"))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """The suffix sums of the encoded lengths of all rows of ``docs`` (see suffix_sums).

    Null and empty texts have length 0. Rows count once each, whatever their doc_id; other columns are ignored; an empty
    table gives an empty result. path: a byte-level tokenizer file that every executor can read.
    """
    return suffix_sums(stored(histogram(counts(docs, path)), "length-histogram"))
