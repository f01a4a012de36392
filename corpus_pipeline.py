"""The corpus pipeline: every stage reads what its predecessor kept, written as Parquet and read again.

Each stage takes (spark, docs, sf_dir). All but the last return rows of ``docs`` with all their columns; the last returns
doc_id, n_tokens and ids of the documents that are left.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import bpe, decontam, exact_dedup, simhash, toxicity
from orderlens.llm.common import documents, labels, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose expected severity reaches the cut go; the model learns from the labels of ``docs``."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels(spark, folder)))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document per distinct text stays: the one with the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document per group of linked fingerprints stays: the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.drop_contaminated(docs, decontam.benchmark(spark, folder))


def encoding_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The token ids of the documents that are left."""
    tokens = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]

#: Learned scores and components have no SQL; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
