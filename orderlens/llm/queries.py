"""The registered queries of this subpackage: op1 to op13 over their whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bpe, decontam, exact_dedup, filter_audit, html_extract, merkle, nearest, pii, quality, simhash, token_counts, token_files, toxicity,
)
from orderlens.llm.common import documents, labels
from orderlens.session import scratch_path


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokens = bpe.encode(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return toxicity.score(docs, toxicity.fit(docs, labels(spark, folder)))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return quality.score(docs, quality.fit(docs, labels(spark, folder)))


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    text = html_extract.extract(pages, html_extract.fit(pages))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(documents(spark, folder), decontam.benchmark(spark, folder))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.resolve_duplicates(documents(spark, folder))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.documents_with_spans(documents(spark, folder))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda k: k == F.lit(n))).cast("long").alias(f"n_{kind}")
              for n, kind in enumerate(pii.KINDS)]
    return rows.select("doc_id", *counts, F.sha2(pii.span_text(base), 256).alias("base_sha256"),
                       pii.span_text(F.col("spans")).alias("spans"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_path(spark, "token-files")
    token_files.write_tokens(documents(spark, folder), files, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.token_index(token_files.read_tokens(spark, files))


def op11_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % nearest.EVERY == 0)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(documents(spark, folder), labels(spark, folder))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(documents(spark, folder), merkle.tamper_sign(F.col("doc_id")))


EXACT_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1 AS kept, h AS text_sha256
FROM d
"""

NEAREST_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
             AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.x, v.x) AS score
      FROM v AS q, v WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.x) = len(v.x)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, place::INT AS rank, vec_id, score FROM r WHERE place <= 5
"""

FILTER_AUDIT_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(quality IS NOT DISTINCT FROM 1) AS good, max(toxic IS NOT DISTINCT FROM 1) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (SELECT *, len(words) AS n_words,
             min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             (n_words < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * n_words)::INT
             + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * (first_id IS NOT NULL AND (w.doc_id IS NULL OR w.doc_id > first_id))::INT AS failed
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f GROUP BY part, failed),
x AS (SELECT unnest(generate_series(0, 4)) AS i),
p AS (SELECT [a.i, b.i, c.i, d.i, 10 - a.i - b.i - c.i - d.i] AS o FROM x a, x b, x c, x d
      WHERE a.i <> b.i AND a.i <> c.i AND a.i <> d.i AND b.i <> c.i AND b.i <> d.i AND c.i <> d.i),
s AS (SELECT list_aggregate(list_transform(o, lambda k: chr((65 + k)::INT)), 'string_agg', '') AS filter_order, x.i + 1 AS step,
             o[x.i + 1] AS f, list_sum(list_transform(o[1:x.i], lambda k: (1 << k)::INT)) AS done FROM p, x),
r AS (SELECT part, filter_order, step, f,
             sum(CASE WHEN failed & (coalesce(done, 0)::INT | (1 << f)::INT) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN failed & coalesce(done, 0)::INT = 0 AND failed & (1 << f)::INT > 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN failed & coalesce(done, 0)::INT > 0 AND failed & (1 << f)::INT > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN failed = 1 << f THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN failed & coalesce(done, 0)::INT = 0 AND failed & (1 << f)::INT > 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN failed & coalesce(done, 0)::INT = 0 AND failed & (1 << f)::INT > 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r
"""

# crc32 is written out bit by bit; levels and folds are recursive.
MERKLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('+' || lang, '') AS tree, doc_id::varchar AS i, source, lang, n_chars, text,
       xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''),
             lambda c: ascii(c)::bigint)), lambda a, c: list_reduce(list_prepend(xor(a, c), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) AS crc FROM documents),
f AS (SELECT *, [coalesce(strlen(i) || ':' || i, '-'), coalesce(strlen(source) || ':' || source, '-'),
                 coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(text) || ':' || text, '-')] AS s FROM d),
leaf AS (SELECT doc_id, tree, sha256(s[1] || s[2] || s[3] || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || s[4]) AS h,
                CASE WHEN crc % 7 = 0 THEN sha256(s[1] || s[2] || s[3]
                     || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || s[4]) END AS tampered FROM f),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, h) - 1 AS pos,
                  count(*) OVER (PARTITION BY tree) AS n FROM leaf),
nodes AS (SELECT tree, 0 AS level, pos, n, h FROM placed
          UNION ALL
          SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
          FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, pos, n, h FROM subs
         UNION ALL
         SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
         FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
root AS (SELECT h AS root FROM tops WHERE n = 1),
chain AS (SELECT p.tree, p.pos AS leaf_pos, k.level, k.pos % 2 AS side, k.h
          FROM placed p JOIN nodes k ON k.tree = p.tree AND k.n > 1 AND k.pos = xor(p.pos >> k.level, 1)
          UNION ALL
          SELECT p.tree, p.pos, 1000 + k.level, k.pos % 2, k.h
          FROM placed p JOIN subs s USING (tree) JOIN tops k ON k.n > 1 AND k.pos = xor(s.pos >> k.level, 1)),
steps AS (SELECT tree, leaf_pos, sha256(string_agg(h, '' ORDER BY level)) AS proof FROM chain GROUP BY tree, leaf_pos),
every AS (SELECT p.tree, p.pos, l.level, c.side, c.h
          FROM placed p
          JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1
                UNION ALL SELECT DISTINCT s.tree, 1000 + t.level FROM subs s, tops t WHERE t.n > 1) l USING (tree)
          LEFT JOIN chain c ON c.tree = p.tree AND c.leaf_pos = p.pos AND c.level = l.level),
way AS (SELECT tree, pos, list({'side': side, 'h': h} ORDER BY level) AS w FROM every GROUP BY tree, pos),
fold AS (SELECT tree, pos, 0 AS k, coalesce(tampered, h) AS g FROM placed
         UNION ALL
         SELECT fold.tree, fold.pos, k + 1, sha256(CASE WHEN w[k + 1].side = 0 THEN w[k + 1].h ELSE '' END || g
                || CASE WHEN w[k + 1].side = 1 THEN w[k + 1].h ELSE '' END)
         FROM fold JOIN way USING (tree, pos) WHERE k < len(w)),
last AS (SELECT tree, pos, arg_max(g, k) AS folded_root FROM fold GROUP BY tree, pos)
SELECT doc_id, p.h AS leaf, s.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM placed p JOIN subs s ON s.tree = p.tree JOIN last l ON l.tree = p.tree AND l.pos = p.pos
LEFT JOIN steps x ON x.tree = p.tree AND x.leaf_pos = p.pos, root
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_html_text": op4_html_text,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_simhash": op7_simhash,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pii": op9_pii,
    "op10_token_files": op10_token_files,
    "op11_nearest": op11_nearest,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle": op13_merkle,
}
SQL: dict[str, str] = {
    "op8_exact_dedup": EXACT_DEDUP_SQL,
    "op11_nearest": NEAREST_SQL,
    "op12_filter_audit": FILTER_AUDIT_SQL,
    "op13_merkle": MERKLE_SQL,
}
