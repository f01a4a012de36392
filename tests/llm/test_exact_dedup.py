import hashlib
import re

import cases
from pyspark.sql import functions as F

from orderlens.llm import exact_dedup as op


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(digest(text), []).append(doc_id)
    out = []
    for d, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), n == 0, d) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def test_edge_cases(spark):
    docs = cases.documents(spark)
    assert cases.plain(op.resolve_duplicates(docs)) == expected([(r[0], r[1]) for r in cases.rows()])
    assert op.resolve_duplicates(cases.empty(spark)).collect() == []
    kept = op.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(digest(r["text"]) for r in kept.collect()) == sorted({digest(r[1]) for r in cases.rows()})
    assert op.drop_duplicates(cases.empty(spark)).collect() == []


def test_heavy_groups_do_not_depend_on_the_summary(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 400}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for heavy, tracked in ((1, 16), (4, 64), (2048, 16384)):
        assert cases.plain(op.resolve_duplicates(docs, heavy, tracked)) == expected(rows)


def test_hot_digest_is_a_winner_of_bounded_count(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'hot', string(id))").alias("digest"))
    winners = op.heavy_digests(rows.withColumn("key", F.xxhash64("digest")), 8, 64).collect()
    assert [(w["digest"], w["keep_id"], w["group_size"]) for w in winners] == [("hot", 0, 1000)]
