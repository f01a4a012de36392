"""Exact dedup with a split for heavy hitters, in DataFrame functions only.

1. Every text is reduced to the SHA-256 of its normalised form; the pair (doc_id, digest) is stored, texts travel no
   further.
2. A Misra-Gries summary (``approx_top_k`` keeps the frequent-items sketch of that family) of fixed size runs over all
   digests with map-side partial summaries. Any digest with more than ``rows / tracked`` rows is among its candidates.
3. The candidates are counted exactly. Those with copies are the winners: at most ``heavy`` rows, so their broadcast has
   a proven bound. Rows of winners are answered on the map side and never meet in one task.
4. The remaining digests go through one shuffle. The most frequent of them has at most ``rows / heavy`` rows, since at
   least ``heavy`` winners have more: a group in a window stays small against a task's share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import id_text, stored

#: Winners broadcast at most, and counters of the Misra-Gries summary.
HEAVY, TRACKED = 2048, 16384


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text after each run of ASCII white space became one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def heavy_digests(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """digest, keep_id, group_size, keepers (rows that carry keep_id) of the frequent digests; ``heavy`` rows at most."""
    found = rows.agg(F.expr(f"approx_top_k(key, {heavy}, {tracked})").alias("top"))
    candidates = found.select(F.inline("top")).select(F.col("item").alias("key"))
    counted = (rows.join(F.broadcast(candidates), "key").groupBy("digest")
               .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"))
    winners = stored(counted.orderBy(F.desc("group_size"), "digest").limit(heavy), "heavy-digests")
    keepers = (rows.join(F.broadcast(winners), "digest").filter("doc_id <=> keep_id").groupBy("digest")
               .agg(F.count("*").alias("keepers")))
    return stored(winners.join(keepers, "digest"), "heavy-digests")


def resolve_duplicates(docs: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``, exactly one kept per distinct text.

    Null text counts as empty text, so null and empty texts are equal. Of equal texts the row with the smallest doc_id
    stays; a null doc_id is the largest, and keep_id is null only if all ids of the group are. Repeated rows with the same
    doc_id and text each appear, one of them kept. Other columns are ignored; an empty table gives an empty result.
    """
    rows = stored(docs.select("doc_id", text_digest(F.col("text")).alias("digest"))
                  .withColumn("key", F.xxhash64("digest")), "digests")
    winners = F.broadcast(heavy_digests(rows, heavy, tracked))
    columns = ["doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")]
    dropped = (rows.join(winners, "digest").filter("NOT doc_id <=> keep_id")
               .withColumn("kept", F.lit(False)).select(*columns))
    kept = (winners.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "keepers")))
            .select(F.col("keep_id").alias("doc_id"), "keep_id", "group_size", (F.col("copy") == 1).alias("kept"),
                    F.col("digest").alias("text_sha256")))
    group = Window.partitionBy("digest")
    ordered = group.orderBy(F.col("doc_id").asc_nulls_last())
    rest = (rows.join(winners, "digest", "left_anti")
            .select("doc_id", F.first("doc_id").over(ordered).alias("keep_id"),
                    F.count("*").over(group).alias("group_size"), (F.row_number().over(ordered) == 1).alias("kept"),
                    "digest").select(*columns))
    return rest.unionByName(dropped).unionByName(kept)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of which one per distinct normalised text remains (see resolve_duplicates)."""
    kept = resolve_duplicates(docs).filter("kept").select(F.col("text_sha256").alias("__digest"),
                                                          id_text("doc_id").alias("__id"))
    keyed = docs.withColumns({"__digest": text_digest(F.col("text")), "__id": id_text("doc_id")})
    order = "row_number() OVER (PARTITION BY __digest, __id ORDER BY text)"
    return (keyed.join(kept, ["__digest", "__id"], "left_semi").withColumn("__n", F.expr(order)).filter("__n = 1")
            .drop("__digest", "__id", "__n"))
