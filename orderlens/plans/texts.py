"""Documents, retrieval, routing and answer audits."""

from pyspark.sql import functions as F

from orderlens.operators import answers, audit, corpus, evidence, retrieval, routing, vector_index
from orderlens.plans.exploration import EVIDENCE_SQL
from orderlens.plans.registry import STAR_SQL, query
from orderlens.session import scratch_path, shuffles_removed
from orderlens.sources import commerce, texts

# ---------------------------------------------------------------- documents

DERIVED = r"""
md AS (SELECT doc_id, concat(if(lang = 'en', concat('# ', source, chr(10), chr(10)), ''),
                             replace(regexp_replace(text, '(?m)^(.{1,60})$', '## \1', 'g'), chr(10), chr(10) || chr(10)))
              AS text FROM documents),
"""
PARSED = r"""
lines AS (SELECT doc_id, line, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS pos
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                       generate_subscripts(string_split(text, chr(10)), 1) AS i FROM md)),
titles AS (SELECT doc_id, coalesce((SELECT trim(substr(l.line, 3)) FROM lines l
                                    WHERE l.doc_id = md.doc_id AND starts_with(l.line, '# ') ORDER BY l.pos LIMIT 1),
                                   doc_id::varchar) AS title FROM md),
heads AS (SELECT doc_id, pos, trim(substr(line, 4)) AS section FROM lines WHERE starts_with(line, '## '))
"""

MARKDOWN = DERIVED + PARSED

query("corpus_titles", lambda spark, folder: texts.markdown(spark, folder).select(
    "doc_id", corpus.document_title(F.col("text"), F.col("doc_id").cast("string")).alias("title")),
    "WITH" + MARKDOWN + "SELECT * FROM titles")

query("corpus_sections", lambda spark, folder: texts.markdown(spark, folder).select(
    "doc_id", F.length("text").alias("n"), corpus.section_heads(F.col("text")).alias("heads")).select(
    "doc_id", F.size("heads").cast("bigint").alias("heads"),
    corpus.section_at(F.col("heads"), F.floor(F.col("n") / 2).cast("int")).alias("middle_section")),
    "WITH" + MARKDOWN + """
SELECT doc_id, (SELECT count(*) FROM heads h WHERE h.doc_id = md.doc_id) AS heads,
       coalesce((SELECT section FROM heads h WHERE h.doc_id = md.doc_id AND h.pos <= length(md.text) // 2
                 ORDER BY pos DESC LIMIT 1), '') AS middle_section FROM md""")

CHUNKING = PARSED + r"""
, para AS (SELECT doc_id, list_transform(regexp_split_to_array(text, '\n\s*\n'),
                                         lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')) AS ps FROM md),
pack AS (
  SELECT doc_id, ps, 0 AS i, '' AS body, 0 AS start, 0 AS pos, NULL::varchar AS flushed, 0 AS flushed_at FROM para
  UNION ALL
  SELECT doc_id, ps, i + 1,
         CASE WHEN p = '' THEN body WHEN body = '' OR flush THEN p ELSE concat(body, chr(10), chr(10), p) END,
         CASE WHEN p <> '' AND (body = '' OR flush) THEN pos ELSE start END, pos + length(p) + 2,
         CASE WHEN flush THEN body END, start
  FROM (SELECT *, ps[i + 1] AS p, p <> '' AND body <> '' AND length(body) + 2 + length(p) > 500 AS flush
        FROM pack WHERE i < len(ps))),
packed AS (SELECT doc_id, i, flushed AS body, flushed_at AS start FROM pack WHERE flushed IS NOT NULL
           UNION ALL SELECT doc_id, i + 1, body, start FROM pack WHERE i = len(ps) AND body <> ''),
cut AS (SELECT doc_id, start, unnest(if(length(body) <= 550, [body],
               list_transform(range(0, length(body), 500), lambda k: substr(body, k + 1, 500)))) AS body, i,
               unnest(if(length(body) <= 550, [0], range(0, length(body), 500))) AS k FROM packed),
piece AS (SELECT doc_id, list({'body': body, 'start': start} ORDER BY i, k) AS cs FROM cut GROUP BY doc_id),
glue AS (
  SELECT doc_id, cs, 1 AS i, cs[1].body AS body, cs[1].start AS start, NULL::varchar AS done_body, 0 AS done_start
  FROM piece
  UNION ALL
  SELECT doc_id, cs, i + 1, if(joins, concat(body, chr(10), chr(10), (c).body), (c).body), if(joins, start, (c).start),
         if(joins, NULL, body), start
  FROM (SELECT *, cs[i + 1] AS c, length(cs[i + 1].body) < 80 AND length(body) + 2 + length(cs[i + 1].body) <= 550 AS joins
        FROM glue WHERE i < len(cs))),
final AS (SELECT doc_id, i, done_body AS content, done_start AS start FROM glue WHERE done_body IS NOT NULL
          UNION ALL SELECT doc_id, i + 1, body, start FROM glue WHERE i = len(cs)),
numbered AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_no, start, content
             FROM final),
chunk AS (SELECT n.doc_id, n.chunk_no, t.title, n.content,
                 coalesce((SELECT section FROM heads h WHERE h.doc_id = n.doc_id AND h.pos <= n.start
                           ORDER BY pos DESC LIMIT 1), '') AS section
          FROM numbered n JOIN titles t USING (doc_id)),
named AS (SELECT doc_id, chunk_no::int AS chunk_no, title, section,
                 if(section = '', title, concat(title, ' › ', section)) AS label, content FROM chunk),
corpus AS (SELECT row_number() OVER (ORDER BY doc_id, chunk_no) - 1 AS chunk_id, * FROM named)
"""
CHUNKS = "WITH RECURSIVE" + DERIVED + CHUNKING
query("corpus_chunks", lambda spark, folder: corpus.chunk_documents(texts.markdown(spark, folder), "doc_id"),
      CHUNKS + "SELECT * FROM named")
query("corpus_chunks_plain", lambda spark, folder: corpus.chunk_documents(
    commerce.table(spark, folder, "documents"), "doc_id").groupBy("doc_id").agg(
    F.count("*").alias("chunks"), F.sum(F.length("content")).alias("chars"), F.max(F.length("content")).alias("longest")),
    "WITH RECURSIVE md AS (SELECT doc_id, text FROM documents)," + CHUNKING + """
SELECT doc_id, count(*) AS chunks, sum(length(content))::bigint AS chars, max(length(content))::int AS longest
FROM named GROUP BY doc_id""")
query("corpus_build", lambda spark, folder: corpus.build_corpus(texts.markdown(spark, folder), "doc_id"),
      CHUNKS + "SELECT * FROM corpus")

# ---------------------------------------------------------------- retrieval


def _vectors(spark, folder):
    return commerce.table(spark, folder, "embeddings").select("vec_id", "embedding")


def search_table(spark, folder):
    """Every chunk of the corpus with a vector; the test tables have fewer vectors than chunks, so they are reused."""
    chunks = corpus.build_corpus(texts.markdown(spark, folder), "doc_id")
    vectors = _vectors(spark, folder)
    keyed = chunks.select("chunk_id", (F.col("chunk_id") % vectors.agg(F.count("*")).scalar()).alias("vec_id"))
    return retrieval.rag_documents(chunks, keyed.join(vectors, "vec_id"))


def question_vectors(spark, folder):
    """(query_id, question, embedding) of every distinct question text: a question asked often is searched once."""
    vectors = _vectors(spark, folder)
    number = F.conv(F.substring(F.md5("question"), 1, 8), 16, 10).cast("bigint")
    asked = texts.questions(spark, folder).select("question").distinct().select(
        F.conv(F.substring(F.md5("question"), 1, 15), 16, 10).cast("bigint").alias("query_id"), "question",
        (number % vectors.agg(F.count("*")).scalar()).alias("vec_id"))
    return asked.join(vectors, "vec_id").select("query_id", "question", "embedding")


# Distinct questions with their vectors, every chunk with its vector, and the four nearest chunks of each question.
SEARCHED = """
, vecs AS (SELECT vec_id, embedding::double[] AS e FROM embeddings),
asks AS (SELECT ('0x' || substr(md5(question), 1, 15))::bigint AS query_id, question,
                ('0x' || substr(md5(question), 1, 8))::bigint % (SELECT count(*) FROM vecs) AS vec_id
         FROM (SELECT DISTINCT question FROM q)),
near AS (SELECT a.vec_id AS asked, v.vec_id AS vec_id, round(list_cosine_similarity(b.e, v.e), 12) AS s
         FROM (SELECT DISTINCT vec_id FROM asks) a JOIN vecs b USING (vec_id), vecs v),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY asked ORDER BY s DESC, vec_id) <= 4
                                    OR s >= nth_value(s, 4) OVER (PARTITION BY asked ORDER BY s DESC, vec_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
stored AS (SELECT chunk_id, label, content, chunk_id % (SELECT count(*) FROM vecs) AS vec_id FROM corpus),
hit AS (SELECT query_id, chunk_id, s, label, content,
               row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank
        FROM asks JOIN best ON asked = asks.vec_id JOIN stored ON stored.vec_id = best.vec_id QUALIFY rank <= 4)
"""

query("retrieval_group_centroids", lambda spark, folder: retrieval.top_k(
    retrieval.centroids(commerce.table(spark, folder, "embeddings"), "label", "embedding"),
    _vectors(spark, folder)), """
WITH v AS (SELECT vec_id, label, embedding::double[] AS e FROM embeddings),
m AS (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v)
      GROUP BY label, i),
c AS (SELECT label, list(x ORDER BY i) AS e FROM m GROUP BY label),
s AS (SELECT c.label AS query_id, vec_id AS vector_id, round(list_cosine_similarity(c.e, v.e), 12) AS s FROM c, v),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vector_id) AS rank FROM s)
SELECT query_id::bigint AS query_id, rank::int AS rank, vector_id, round(s, 3) AS similarity FROM r WHERE rank <= 4""")

# ---------------------------------------------------------------- routing


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ASKED = "q AS (SELECT concat('c-', conv_id, '-', turn) AS question_id, text AS question FROM conversations " \
        "WHERE role = 'user' UNION ALL SELECT concat('o-', o_orderkey), replace([" + \
        ", ".join(_text(t) for t in texts.QUESTIONS) + \
        f"][o_orderkey % {len(texts.QUESTIONS)} + 1], '{{year}}', year(o_orderdate)::varchar) FROM orders)"


def _hits(spark, folder):
    path = scratch_path(spark, "search-vectors")
    table = search_table(spark, folder).select("id", "embedding")
    with shuffles_removed(spark):
        table.write.parquet(path)
    table = spark.read.schema(table.schema).parquet(path)
    return retrieval.top_k(question_vectors(spark, folder).select("query_id", "embedding"), table)


query("retrieval_top_k", _hits, CHUNKS + ", " + ASKED + SEARCHED + """
SELECT query_id, rank::int AS rank, chunk_id AS vector_id, round(s, 3) AS similarity FROM hit""")


def _index(spark, folder):
    return vector_index.build_index(_vectors(spark, folder), scratch_path(spark, "vector-index"))


def _asked(spark, folder):
    return question_vectors(spark, folder).select("query_id", "embedding")


ASKS = "WITH " + ASKED + """,
vecs AS (SELECT vec_id, embedding::double[] AS e FROM embeddings),
asks AS (SELECT ('0x' || substr(md5(question), 1, 15))::bigint AS query_id,
                ('0x' || substr(md5(question), 1, 8))::bigint % (SELECT count(*) FROM vecs) AS vec_id
         FROM (SELECT DISTINCT question FROM q)),
"""
query("retrieval_indexed_top_k", lambda spark, folder: vector_index.top_k(_index(spark, folder), _asked(spark, folder)),
      ASKS + """
near AS (SELECT a.vec_id AS asked, v.vec_id, round(list_cosine_similarity(b.e, v.e), 12) AS s,
                row_number() OVER (PARTITION BY a.vec_id ORDER BY s DESC, v.vec_id) AS rank
         FROM (SELECT DISTINCT vec_id FROM asks) a JOIN vecs b USING (vec_id), vecs v QUALIFY rank <= 4)
SELECT query_id, rank::int AS rank, near.vec_id AS vector_id, round(s, 3) AS similarity
FROM asks JOIN near ON asked = asks.vec_id""")
query("retrieval_pruning", lambda spark, folder: vector_index.pruning(_index(spark, folder), _asked(spark, folder)),
      ASKS + f"""
pivots AS (SELECT row_number() OVER (ORDER BY md5(vec_id::varchar), vec_id) AS p, e FROM vecs QUALIFY p <= {vector_index.PIVOTS}),
far AS (SELECT vec_id, p, sqrt(greatest(2 - 2 * list_cosine_similarity(v.e, r.e), 0)) AS d FROM vecs v, pivots r),
cell AS (SELECT vec_id, arg_min(p, d) AS p, min(d) AS d FROM far GROUP BY vec_id),
most AS (SELECT vec_id, min(d) AS least, list_sort(list(d))[4] + 4e-6 AS most FROM far GROUP BY vec_id),
kept AS (SELECT f.vec_id, count(*) AS n FROM far f JOIN most m USING (vec_id) JOIN cell c USING (p)
         WHERE abs(f.d - c.d) <= most AND (f.d - least) / 2 <= most GROUP BY f.vec_id)
SELECT (SELECT count(*) FROM asks) AS questions, (SELECT count(*) FROM vecs) AS vectors,
       (SELECT count(*) FROM asks) * (SELECT count(*) FROM vecs) AS pairs,
       (SELECT sum(n) FROM asks JOIN kept USING (vec_id))::bigint AS pairs_left""")


def _m(pattern: str) -> str:
    return f"regexp_matches(l, {_text(pattern)})"


# This engine knows only ASCII word characters, so accented letters are replaced by another word character first.
ROUTED = ASKED + f""",
lowered AS (SELECT *, regexp_replace(lower(question), '[À-ÖØ-öø-ɏ]', '_', 'g') AS l FROM q),
scoped AS (SELECT *, list_filter(regexp_extract_all(l, {_text(routing.YEAR)}),
                                 lambda y: y NOT IN {texts.YEARS}) AS ys,
                  regexp_extract(l, {_text(routing.OUT_OF_SCOPE)}) AS word FROM lowered),
reasoned AS (SELECT *, CASE WHEN len(ys) > 0
       THEN concat('it asks about ', ys[1], ', but the warehouse covers {min(texts.YEARS)}-{max(texts.YEARS)} only')
       WHEN word <> '' THEN concat('''', word, ''' is not tracked in any table of this warehouse') END AS scope_reason
  FROM scoped),
judged AS (SELECT *, {' OR '.join(_m(p) for p in routing.DOCUMENT_ALWAYS)} AS always,
                  {_m(routing.NUMERIC_WORDS)} AS num, {_m(routing.DOCUMENT_WORDS)} AS doc FROM reasoned),
routed AS (SELECT question_id, question, scope_reason,
       CASE WHEN scope_reason IS NOT NULL THEN 'refuse' WHEN always THEN 'document' WHEN num AND doc THEN 'mixed'
            WHEN num THEN 'numeric' WHEN doc THEN 'document' ELSE 'mixed' END AS route,
       list_filter([{', '.join(f"CASE WHEN {_m(p)} THEN {_text(n)} END" for n, p in routing.INTENTS.items())}],
                   lambda x: x IS NOT NULL) AS hits FROM judged),
answered AS (SELECT * EXCLUDE (hits), if(len(hits) > 0, hits, [{_text(routing.FALLBACK_INTENT)}]) AS intents FROM routed)
"""


def _routed(spark, folder):
    return routing.route_questions(texts.questions(spark, folder), texts.YEARS)


query("routing_scope", lambda spark, folder: texts.questions(spark, folder).select(
    "question_id", routing.scope_reason(F.col("question"), texts.YEARS).alias("scope_reason")),
    "WITH " + ROUTED + "SELECT question_id, scope_reason FROM answered")
query("routing_route", lambda spark, folder: _routed(spark, folder).select("question_id", "route"),
      "WITH " + ROUTED + "SELECT question_id, route FROM answered")
query("routing_intents", lambda spark, folder: texts.questions(spark, folder).select(
    "question_id", F.array_join(routing.intents(F.col("question")), "; ").alias("intents")),
    "WITH " + ROUTED + "SELECT question_id, array_to_string(intents, '; ') AS intents FROM answered")

def _evidence(spark, folder):
    """Every distinct question is routed, searched and given its evidence once: (routed, packs). The table of chunks is
    built once and stored."""
    path = scratch_path(spark, "search-table")
    with shuffles_removed(spark):
        search_table(spark, folder).write.parquet(path)
    table = spark.read.parquet(path)
    asked = question_vectors(spark, folder)
    found = retrieval.passages(retrieval.top_k(asked.select("query_id", "embedding"), table.select("id", "embedding")), table)
    routed = routing.route_questions(asked.select(F.col("query_id").alias("question_id"), "question"), texts.YEARS)
    return routed, evidence.evidence_packs(routed, evidence.evidence_table(commerce.stored_star(spark, folder)), found)


def _packs(spark, folder):
    """The packs go to all who asked the question."""
    packs = _evidence(spark, folder)[1].select(
        F.col("question_id").alias("query_id"), F.col("blocks").cast("bigint").alias("blocks"),
        F.length("pack").cast("bigint").alias("chars"), F.md5("pack").alias("pack_md5"))
    named = texts.questions(spark, folder).select("question_id", F.conv(F.substring(F.md5("question"), 1, 15), 16, 10)
                                                  .cast("bigint").alias("query_id"))
    return named.join(packs, "query_id").drop("query_id")


query("evidence_packs", _packs, STAR_SQL.replace("WITH", "WITH RECURSIVE", 1) + EVIDENCE_SQL + ", " + DERIVED
    + CHUNKING + ", " + ROUTED + SEARCHED + """
, picked AS (SELECT question_id, unnest(intents) AS intent, generate_subscripts(intents, 1) AS k FROM answered
             WHERE route IN ('numeric', 'mixed')),
part AS (SELECT question_id, 0 AS kind, k, part, label, content FROM picked JOIN blocks USING (intent)
         UNION ALL SELECT question_id, 1, rank, 0, concat('DOC: ', label), content
         FROM answered JOIN asks USING (question) JOIN hit USING (query_id)
         WHERE route IN ('document', 'mixed', 'refuse')),
entry AS (SELECT question_id, label, content,
                 row_number() OVER (PARTITION BY question_id ORDER BY kind, k, part) AS n FROM part),
bundle AS (SELECT question_id, count(*) AS blocks,
                  string_agg(concat('[E', n, '] ', label, chr(10), content), chr(10) || chr(10) ORDER BY n) AS p
           FROM entry GROUP BY question_id)
SELECT question_id, blocks, length(p) AS chars, md5(p) AS pack_md5 FROM bundle""")

# ---------------------------------------------------------------- audits

REPLY = "replace(" * 4 + "[" + ", ".join(_text(r) for r in texts.REPLIES) + \
        f"][o_orderkey % {len(texts.REPLIES)} + 1], '{{a}}', a), '{{g}}', g), '{{y}}', y), '{{c}}', o_custkey::varchar)"

AUDIT = r"""
WITH amount AS (SELECT *, round(o_totalprice * 100)::bigint AS cents, cents // 100 AS whole,
                       concat(whole, '.', lpad((cents % 100)::varchar, 2, '0')) AS a,
                       concat(whole // 1000, ',', lpad((whole % 1000)::varchar, 3, '0'), '.',
                              lpad((cents % 100)::varchar, 2, '0')) AS g, year(o_orderdate)::varchar AS y FROM orders),
reply AS (SELECT o_orderkey AS id, concat('What was the order worth in ', y, '?') AS question, """ + REPLY + r""" AS raw,
                 concat('order_value=', a, ', customer=', o_custkey, ' In ', y,
                        ' 046% of late delivered orders got one star.') AS ev FROM amount),
parts AS (SELECT *, '(?is)ANSWER:\s*(.*?)\s*CITATIONS:\s*(.*)$' AS pat, regexp_matches(raw, pat) AS ok FROM reply),
clean AS (SELECT id, question, raw, ev,
                 translate(regexp_replace(if(ok, regexp_extract(raw, '(?is)ANSWER:\s*(.*?)\s*CITATIONS:\s*(.*)$', 1), raw),
                                          '^\s+|\s+$', '', 'g'), '［【「〔『］】」〕』', '[[[[[]]]]]') AS answer,
                 translate(regexp_replace(if(ok, regexp_extract(raw, '(?is)ANSWER:\s*(.*?)\s*CITATIONS:\s*(.*)$', 2), ''),
                                          '^\s+|\s+$', '', 'g'), '［【「〔『］】」〕』', '[[[[[]]]]]') AS cit_block FROM parts),
found AS (SELECT *, regexp_extract_all(answer, '\[?\s*E\s*(\d+)\s*\]?', 1) AS f0,
                 regexp_extract_all(cit_block, 'E(\d+)', 1) AS l0 FROM clean),
uniq AS (SELECT *, list_filter(f0, lambda x, i: list_position(f0, x) = i) AS f,
                list_filter(l0, lambda x, i: list_position(l0, x) = i) AS l FROM found),
kinds AS (SELECT *, list_filter(f, lambda x: x IN ('1', '2')) AS fk, list_filter(l, lambda x: x IN ('1', '2')) AS lk,
                 list_sort(list_filter(f, lambda x: x NOT IN ('1', '2'))) AS fb,
                 list_sort(list_filter(l, lambda x: x NOT IN ('1', '2'))) AS lb FROM uniq),
marked AS (SELECT * EXCLUDE (answer), if(len(fb) = 0, answer, regexp_replace(
             list_reduce(list_prepend(answer, fb),
                         lambda t, b: replace(t, concat('[E', b, '] '), '[citation removed] ')),
             '\[citation removed\]\s*([.,;:]|$)', '\1', 'g')) AS answer, if(len(fk) > 0, fk, lk) AS cited FROM kinds),
claims AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(answer, '\[?\s*E\s*\d+\s*\]?', '', 'g'),
                     '(?m)^\s*\d+\.\s*', '', 'g'), '(\s)\d+\.(\s)', '\1\2', 'g') AS c FROM marked),
nums AS (SELECT *, regexp_extract_all(c, '\d[\d,]*\.?\d*%?') AS ns,
                list_transform(list_concat(regexp_extract_all(ev, '\d[\d,]*\.?\d*%?'),
                                           regexp_extract_all(question, '\d[\d,]*\.?\d*%?')),
                  lambda n: ltrim(rtrim(rtrim(replace(n, ',', ''), '%'), '.'), '0')) AS known,
                regexp_extract_all(c, '\d[\d,.]*\s*%\s*of\b') AS ps,
                regexp_split_to_array(c, '\d[\d,.]*\s*%\s*of\b') AS seg FROM claims),
tails AS (SELECT *, list_transform(range(1, len(ps) + 1), lambda i: regexp_extract(left(array_to_string(
                      list_transform(range(i, len(ps) + 1), lambda j: concat(seg[j + 1], coalesce(ps[j + 1], ''))), ''),
                      80), '^[^.;:!?\n]*')) AS ts FROM nums),
audited AS (SELECT id, question, raw, answer, cit_block, cited,
  list_filter(lk, lambda x: NOT list_contains(cited, x)) AS uncited, list_concat(fb, lb) AS unknown_citations,
  list_sort(list_distinct(list_filter(ns, lambda n: NOT list_contains(known,
            ltrim(rtrim(rtrim(replace(n, ',', ''), '%'), '.'), '0'))))) AS unsupported_numbers,
  list_filter(list_transform(ts, lambda t, i:
      if(len(regexp_extract_all(t, '[A-Za-z][A-Za-z''-]+')) < 2
         OR regexp_matches(t, '(?i)^\s*(them|their|it|those|these|the same|this)\b'),
         left(regexp_replace(regexp_replace(concat(ps[i], ' ', t), '\s+', ' ', 'g'), '^ | $', '', 'g'), 100), NULL)),
    lambda x: x IS NOT NULL) AS missing_denominator, len(cited) > 0 AS parse_ok,
  regexp_matches(answer, """ + _text(audit.REFUSAL) + r""") AS refusal FROM tails)
"""


def _audited(spark, folder):
    return audit.audit_answers(texts.answers(spark, folder))


def _joined(*columns):
    return [F.array_join(c, "; ").alias(c) for c in columns]


query("audit_sections", lambda spark, folder: audit.with_sections(texts.answers(spark, folder)).select(
    "id", "answer", "cit_block"), AUDIT + "SELECT id, answer, cit_block FROM clean")
query("audit_citations", lambda spark, folder: audit.with_citations(
    audit.with_sections(texts.answers(spark, folder))).select("id", "answer", *_joined(
        "cited", "uncited", "unknown_citations")), AUDIT + """
SELECT id, answer, array_to_string(cited, '; ') AS cited, array_to_string(uncited, '; ') AS uncited,
       array_to_string(unknown_citations, '; ') AS unknown_citations FROM audited""")
query("audit_normal_numbers", lambda spark, folder: texts.answers(spark, folder).select(
    "id", F.explode(F.regexp_extract_all("raw", F.lit(audit.NUMBER), F.lit(0))).alias("number")).select(
    "id", "number", audit.normal_number(F.col("number")).alias("normal")), AUDIT + r"""
, n AS (SELECT id, unnest(regexp_extract_all(raw, '\d[\d,]*\.?\d*%?')) AS number FROM reply)
SELECT id, number, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(replace(number, ',', ''),
       '%+$', ''), '\.+$', ''), '^0+', ''), ''), '0') AS normal FROM n""")
query("audit_numbers", lambda spark, folder: _audited(spark, folder).select("id", *_joined("unsupported_numbers")),
      AUDIT + "SELECT id, array_to_string(unsupported_numbers, '; ') AS unsupported_numbers FROM audited")
query("audit_denominators", lambda spark, folder: _audited(spark, folder).select("id", *_joined("missing_denominator")),
      AUDIT + "SELECT id, array_to_string(missing_denominator, '; ') AS missing_denominator FROM audited")
query("audit_refusals", lambda spark, folder: _audited(spark, folder).select(
    "id", audit.is_refusal(F.col("answer")).alias("refusal")), AUDIT + "SELECT id, refusal FROM audited")


# The route each question of texts.QUESTIONS must take; a year outside the data makes some of them differ.
EXPECTED = [kind for kind, _ in routing.ACCEPTANCE] + ["numeric", "document", "mixed", "refuse"]


def _accepted(spark, folder):
    """Audited answers with the router's own route for the order's question and the expected one."""
    routed = _routed(spark, folder).filter(F.col("question_id").startswith("o-")).select(
        F.substring("question_id", 3, 30).cast("bigint").alias("id"), "route")
    expected = F.element_at(F.array(*[F.lit(r) for r in EXPECTED]), (F.col("id") % len(EXPECTED) + 1).cast("int"))
    return audit.acceptance(_audited(spark, folder).join(routed, "id").withColumn("expected_route", expected))


FLAGS = AUDIT + ", " + ROUTED + f"""
, ruled AS (SELECT a.*, r.route, [{', '.join(_text(r) for r in EXPECTED)}][id % {len(EXPECTED)} + 1] AS want
            FROM audited a JOIN answered r ON r.question_id = concat('o-', a.id)),
""" + """flagged AS (SELECT id, list_filter([
    if(route <> want, concat('route-mismatch (expected ', want, ')'), NULL),
    if(want = 'refuse' AND NOT refusal, 'NOT-A-REFUSAL (never says the info is missing)', NULL),
    if(len(cited) = 0, 'NO-CITATIONS', NULL),
    if(len(unsupported_numbers) > 0, concat('INVENTED-NUMBERS ', array_to_string(unsupported_numbers, ', ')), NULL),
    if(len(unknown_citations) > 0, concat('BOGUS-CITATIONS ', array_to_string(unknown_citations, ', ')), NULL),
    if(len(missing_denominator) > 0, concat('MISSING-DENOMINATOR ', array_to_string(missing_denominator, ', ')), NULL)
  ], lambda x: x IS NOT NULL) AS flags FROM ruled)
"""
query("audit_acceptance", lambda spark, folder: _accepted(spark, folder).select("id", *_joined("flags")),
      FLAGS + "SELECT id, array_to_string(flags, '; ') AS flags FROM flagged")
query("audit_acceptance_summary", lambda spark, folder: audit.acceptance_summary(_accepted(spark, folder)),
      FLAGS + "SELECT count(*) AS questions, count_if(len(flags) > 0) AS with_flags FROM flagged")

# ---------------------------------------------------------------- questions to audited answers

# Replies to a pack: {n} its first number, {last} and {next} the number of its last block and one that does not exist.
PACK_REPLIES = [
    "ANSWER:\nThe figure is {n} [E1].\n\nCITATIONS:\nE1",
    "ANSWER: It is {n} [E1] and 123456.789 [E{next}] .\nCITATIONS: E1 E{last}",
    "ANSWER: I do not have this information. CITATIONS: ",
    "It was {n} [E1], which is 7% of it [E{last}].",
    "ANSWER: No figure is given, 12.5% of all delivered orders were late [E{last}].\nCITATIONS: E{next}",
]


def _replied(spark, folder):
    path = scratch_path(spark, "packs")
    routed, packs = _evidence(spark, folder)
    with shuffles_removed(spark):
        packs.select("question_id", "evidence").write.parquet(path)
    packs = spark.read.parquet(path)
    contents = F.array_join(F.transform("evidence", lambda e: e["content"]), " ")
    number = F.regexp_extract(contents, audit.UNICODE + audit.NUMBER, 0)
    template = F.element_at(F.array(*[F.lit(t) for t in PACK_REPLIES]),
                            (F.col("question_id") % len(PACK_REPLIES) + 1).cast("int"))
    last = F.size("evidence")
    for name, value in (("{n}", number), ("{last}", last.cast("string")), ("{next}", (last + 1).cast("string"))):
        template = F.replace(template, F.lit(name), value)
    return answers.audited_answers(routed, packs, packs.select("question_id", template.alias("raw")))


PACKS = STAR_SQL.replace("WITH", "WITH RECURSIVE", 1) + EVIDENCE_SQL + ", " + DERIVED + CHUNKING + ", " \
    + ROUTED + SEARCHED + """
, texted AS (SELECT query_id, any_value(route) AS route, any_value(intents) AS intents, any_value(question) AS question
             FROM answered JOIN asks USING (question) GROUP BY query_id),
picked AS (SELECT query_id, unnest(intents) AS intent, generate_subscripts(intents, 1) AS k FROM texted
           WHERE route IN ('numeric', 'mixed')),
given AS (SELECT query_id, 0 AS kind, k, part, content FROM picked JOIN blocks USING (intent)
          UNION ALL SELECT query_id, 1, rank, 0, content FROM texted JOIN hit USING (query_id)
          WHERE route IN ('document', 'mixed', 'refuse')),
held AS (SELECT query_id, count(*)::int AS nb, string_agg(content, ' ' ORDER BY kind, k, part) AS ev FROM given GROUP BY query_id),
"""

# The audit of any reply with nb blocks whose contents are ev, as the audits above do it for two blocks.
AUDIT_ANY = (AUDIT[AUDIT.index("parts AS ("):].replace("clean AS (SELECT id, question, raw, ev,", "clean AS (SELECT id, question, raw, ev, nb,")
             .replace("x NOT IN ('1', '2')", "NOT (length(x) < 9 AND x::bigint::varchar = x AND x::bigint BETWEEN 1 AND nb)")
             .replace("x IN ('1', '2')", "length(x) < 9 AND x::bigint::varchar = x AND x::bigint BETWEEN 1 AND nb"))
REPLIED = PACKS + "reply AS (SELECT query_id AS id, question, nb, ev, replace(replace(replace([" + \
    ", ".join(_text(t) for t in PACK_REPLIES) + f"][query_id % {len(PACK_REPLIES)} + 1], '{{n}}', " + \
    f"regexp_extract(ev, {_text(audit.NUMBER)})), '{{last}}', nb::varchar), '{{next}}', (nb + 1)::varchar) AS raw " + \
    "FROM held JOIN texted USING (query_id)),\n" + AUDIT_ANY + f"""
, wanted(question, want) AS (VALUES {', '.join(f'({_text(q)}, {_text(r)})' for r, q in routing.ACCEPTANCE)}),
judged_reply AS (SELECT a.*, t.route, coalesce(w.want, t.route) AS want, w.want IS NOT NULL AS fixed FROM audited a
                 JOIN texted t ON t.query_id = a.id LEFT JOIN wanted w ON w.question = a.question),
flagged AS (SELECT *, list_filter([
    if(route <> want, concat('route-mismatch (expected ', want, ')'), NULL),
    if(want = 'refuse' AND NOT refusal, 'NOT-A-REFUSAL (never says the info is missing)', NULL),
    if(len(cited) = 0, 'NO-CITATIONS', NULL),
    if(len(unsupported_numbers) > 0, concat('INVENTED-NUMBERS ', array_to_string(unsupported_numbers, ', ')), NULL),
    if(len(unknown_citations) > 0, concat('BOGUS-CITATIONS ', array_to_string(unknown_citations, ', ')), NULL),
    if(len(missing_denominator) > 0, concat('MISSING-DENOMINATOR ', array_to_string(missing_denominator, ', ')), NULL)
  ], lambda x: x IS NOT NULL) AS flags FROM judged_reply)
"""
query("answers_audited", lambda spark, folder: _replied(spark, folder).select(
    "question_id", "route", *_joined("cited", "uncited", "unknown_citations", "unsupported_numbers", "missing_denominator",
                                     "flags")), REPLIED + """
SELECT id AS question_id, route, """ + ", ".join(f"array_to_string({c}, '; ') AS {c}" for c in (
    "cited", "uncited", "unknown_citations", "unsupported_numbers", "missing_denominator", "flags")) + " FROM flagged")
query("answers_acceptance", lambda spark, folder: answers.acceptance_of_fixed_questions(_replied(spark, folder)), REPLIED + """
SELECT count(*) AS questions, count_if(len(flags) > 0) AS with_flags FROM flagged WHERE fixed""")
