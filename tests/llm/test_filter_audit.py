import re
from collections import Counter
from itertools import permutations

import cases
import numpy as np
import pyarrow as pa

from orderlens.llm import filter_audit as op
from orderlens.llm.queries import op12_filter_audit

LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """The set of failed filters of each (doc_id, text, source)."""
    found = []
    for doc_id, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        earlier = [i for i, t, _ in rows if (t or "") == (text or "") and i is not None and (doc_id is None or i < doc_id)]
        found.append({f for f, fails in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text or "")) > 2 * len(text or ""), re.search("[#$%&*|]", text or ""), earlier))
            if fails})
    return found


def by_hand(rows, labels):
    failed, out = failures(rows), []
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for part in {s or "" for *_, s in rows}:
        mine = [n for n, r in enumerate(rows) if (r[2] or "") == part]
        steps, total = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [n for n in left if f in failed[n]]
                left = [n for n in left if f not in failed[n]]
                total[f] += len(gone)
                steps.append((part, order, step, len(left), len(gone), sum(f in failed[n] for n in mine) - len(gone),
                              sum(failed[n] == {f} for n in mine), sum(rows[n][0] in good for n in gone),
                              sum(rows[n][0] in toxic for n in gone), f))
        out += [(*s[:-1], total[s[-1]]) for s in steps]
    return sorted(out, key=repr)


def test_edge_cases(spark):
    docs = cases.documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, None), (9, 1, 1), (None, 1, 1), (14, 0, 1)]
    for shard_bytes in (1 << 22, 100):
        got = op.audit(docs, spark.createDataFrame(labels, LABELS), shard_bytes)
        assert cases.plain(got) == by_hand(rows, labels)
    assert op.audit(cases.empty(spark), spark.createDataFrame(labels, LABELS)).collect() == []
    assert cases.plain(op.audit(docs, spark.createDataFrame([], LABELS))) == by_hand(rows, [])


def test_hot_sources_and_copies(spark):
    prose = " ".join(f"w{i}" for i in range(230))
    texts = [prose, prose + " #", "W" + prose, "A B C", "a " * 250, prose.upper() + " $", ""]
    rows = [(i, texts[i % 3 * (i % 7) % 7], ["hot", None, "", "b", "hot"][i % 5]) for i in range(150)] + [(None, prose, "x")] * 3
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 150, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9)
    marked = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], LABELS)
    assert cases.plain(op.audit(docs, marked, 3000)) == by_hand(rows, labels)


def test_matrix_is_the_texts_counted(spark):
    """Columns mean the same word in every shard, and the matrix holds all words and counts."""
    docs = cases.documents(spark)
    dictionary, shards = op.document_terms(docs, 2000)
    words = {r["id"]: bytes(r["word"]) for r in dictionary.collect()}
    assert dictionary.count() == len(words) == len(set(words.values()))
    found, made = [], shards.collect()
    assert len(made) > 4
    for s in made:
        for i, doc_id in enumerate(s["doc_id"]):
            span = slice(s["first"][i], s["first"][i + 1])
            assert len(set(s["columns"][span])) == len(s["columns"][span])
            found.append((doc_id, Counter(dict(zip((words[c] for c in s["columns"][span]), s["counts"][span])))))
    wanted = [(i, Counter((t or "").encode().split())) for i, t, *_ in cases.rows()]
    assert Counter((i, frozenset(c.items())) for i, c in found) == Counter((i, frozenset(c.items())) for i, c in wanted)


def test_words_of_texts():
    texts = ["", " ", "a  b\ta ", "\x0b\x0cé\x85é é\x1ca\r\n", "b", "\u2003 x"]
    words, first, columns, counts = op._entries(pa.array([t.encode() for t in texts], pa.large_binary()))
    for n, text in enumerate(texts):
        span = slice(first[n], first[n + 1])
        assert Counter(dict(zip((words[int(c)].as_py() for c in columns[span]), counts[span].tolist()))) == Counter(
            text.encode().split())


def test_planes():
    for values in ([], [0], [1, 255, 256, 70_000, 2**31 - 1]):
        assert op.from_planes(op.planes(np.array(values, np.int32))).tolist() == values


def test_capitals_and_signs():
    texts = ["", "A" * 2 + "b" * 98, "A" * 3 + "b" * 97, "é" * 50 + "A", "x|y", "plain"]
    capitals, signs = op._marks(pa.array([t.encode() for t in texts], pa.large_binary()))
    assert capitals.tolist() == [False, False, True, False, False, False]
    assert signs.tolist() == [False, False, False, False, True, False]


def test_test_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert cases.plain(op12_filter_audit(spark, small)) == by_hand(rows, labels)
