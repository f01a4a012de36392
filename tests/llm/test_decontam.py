import random
import re
import tracemalloc

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlens.llm import decontam as op
from orderlens.llm import vectext
from orderlens.llm.vectext import split_words


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_subsequence():
    draw = random.Random(1)
    for _ in range(400):
        a, b = ([draw.randint(0, 6) for _ in range(draw.randint(1, 90))] for _ in range(2))
        assert op.common_length(op.word_masks(a), len(a), b) == lcs(a, b)


def test_term_weights_count_blocks(spark):
    texts = ["a b c " * 10, "a " * 40, None, "", "b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    idf = op.term_weights(docs.repartition(3))
    words = [(t or "").split() for t in texts]
    blocks = [set(w[i:i + op.BLOCK]) for w in words for i in range(0, len(w), op.BLOCK)]
    for word in "abc":
        term = op.term_ids(split_words(pa.array([word])))[0]
        assert idf[term] == pytest.approx(np.log(1 + len(blocks) / sum(word in b for b in blocks)))


def test_range_sums_are_the_product(spark):
    draw = np.random.default_rng(0)
    rows = [(sorted(draw.choice(op.TERMS, 5, replace=False).tolist()), draw.random(5).tolist()) for _ in range(30)]
    frame = spark.createDataFrame(rows, "terms array<int>, weights array<float>").repartition(4)
    dense = np.zeros((30, op.TERMS))
    for i, (terms, weights) in enumerate(rows):
        dense[i, terms] = weights
    factor = draw.standard_normal((op.TERMS, 3))
    assert np.allclose(op.gram_product(frame, factor), dense.T @ (dense @ factor), atol=1e-4)


def prose(draw, words):
    return " ".join(draw.choice(VOCABULARY) for _ in range(words))


VOCABULARY = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ra", "te") for b in ("n", "r", "st", "") for c in
              ("on", "et", "is", "um", "a", "ore", "ing", "al")]


def test_whole_cut_and_reworded_items_are_found(spark):
    draw = random.Random(5)
    items = [(i, prose(draw, 12 + i % 45)) for i in range(60)]
    rows, wanted = [], set()
    for i in range(600):
        text = prose(draw, draw.choice([5, 40, 300, 2000])).split()
        if i % 3 == 0:
            number, item = items[i % 60]
            words = item.split()
            if i % 2:  # one word in ten is another
                words = [draw.choice(VOCABULARY) if n % 10 == 4 else w for n, w in enumerate(words)]
            at = draw.randint(0, len(text))
            text[at:at] = [w.upper() if i % 4 == 0 else w for w in words]
            wanted.add((i, number))
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op.contaminated(docs, bench).collect()}
    assert len(got & wanted) / len(wanted) >= 0.97
    assert len(got - wanted) <= 3
    kept = {r["doc_id"] for r in op.drop_contaminated(docs, bench).collect()}
    assert kept == {i for i, _ in rows} - {d for d, _ in got}


def test_candidate_recall_against_brute_force(spark, small):
    """Every document that holds all words of an item in a row is found, and nothing else in the test table."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = op.benchmark(spark, small)
    squeezed = [(r["item_id"], " ".join(r["text"].split())) for r in bench.collect()]
    wanted = {(r["doc_id"], i) for r in docs.collect() for i, t in squeezed if t in " ".join(r["text"].split())}
    got = {(r["doc_id"], r["item_id"]) for r in op.contaminated(docs, bench).collect()}
    assert len(got & wanted) >= 0.9 * len(wanted) and wanted
    for doc_id, item in got - wanted:  # what else is found shares most of the item's words in order
        text = docs.filter(f"doc_id = {doc_id}").first()["text"]
        a, b = (re.findall(r"\w+", t.lower()) for t in (dict(squeezed)[item], text))
        assert lcs(a, b) >= op.SHARE * len(a)


def test_answers_decide(spark):
    item = "what is the name of the river that flows through the old town of the northern county please say now"
    docs = spark.createDataFrame([(1, f"intro text here {item} the answer is silver stream"), (2, f"only {item} and more")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, item, "silver stream")], "item_id long, text string, answer string")
    assert [r["doc_id"] for r in op.contaminated(docs, bench).collect()] == [1]


def test_several_blocks_of_items(spark, small, monkeypatch):
    docs, bench = spark.read.parquet(f"{small}/documents.parquet"), op.benchmark(spark, small)
    one = cases.plain(op.contaminated(docs, bench).select("doc_id", "item_id"))
    idf = op.term_weights(docs)
    table = op.latent_space(docs, bench, idf)
    monkeypatch.setattr(op, "ITEMS", 7)
    indexes = op.ItemBlocks(bench, table)
    assert len(indexes) > 1
    assert cases.plain(op.contaminated(docs, bench, indexes).select("doc_id", "item_id")) == one


def test_edge_cases(spark):
    docs = cases.documents(spark)
    bench = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, cases.PROSE, None), (4, "a", "b"), (4, "a", "b"),
                                   (5, cases.LONG[:20_000], "x")], "item_id long, text string, lang string")
    got = cases.plain(op.contaminated(docs, bench).select("doc_id", "item_id").distinct())
    prose = {(i, None) for i in (1, 2, 14, None)}
    assert prose <= set(got) and {(7, 5), (8, 5), (15, 4)} <= set(got)
    kept = op.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and not {1, 2, 7, 8, 14, 15} & {r["doc_id"] for r in kept.collect()}
    for left, right in ((cases.empty(spark), bench), (docs, bench.limit(0)), (cases.empty(spark), bench.limit(0))):
        assert op.contaminated(left, right).collect() == []
    assert op.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_more_items_than_the_sample(spark):
    """Items beyond the size of the document sample, in words that no sampled document has, are found, also reworded."""
    draw = random.Random(11)
    texts = [r["text"].split() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
             .select("text").collect()]
    texts = [t for t in texts if len(t) >= 120]
    fillers, sources = texts[:200], texts[200:]
    items = []
    for i in range(op.SAMPLE_DOCS + 600):
        source, size = sources[i % len(sources)], draw.randint(15, 59)
        at = draw.randint(0, len(source) - size)
        items.append((i, " ".join(w + "q" * (i >= op.SAMPLE_DOCS) for w in source[at:at + size])))
    known = [w for t in fillers for w in t]
    ids = [r["id"] for r in spark.range(op.SAMPLE_DOCS + 300).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(n, " ".join(draw.choice(fillers)[:90])) for n in ids[:op.SAMPLE_DOCS]]
    planted = []
    for n, (i, item) in zip(ids[op.SAMPLE_DOCS:], draw.sample(items[op.SAMPLE_DOCS:], 300)):
        rate = (0, 0.1, 0.25)[len(planted) % 3]
        copy = [draw.choice(known) if draw.random() < rate else w for w in item.split()]
        filler = draw.choice(fillers)[:90]
        at = draw.randint(0, len(filler))
        rows.append((n, " ".join(filler[:at] + copy + filler[at:])))
        a, b = (split_words(pa.array([t])).hashes.tolist() for t in (item, " ".join(copy)))
        planted.append((rate, n, i, lcs(a, b) >= op.SHARE * len(a)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["item_id"]) for r in op.contaminated(docs, bench).collect()}
    for rate, least in ((0, 0.97), (0.1, 0.95), (0.25, 0.9)):
        wanted = {(n, i) for r, n, i, there in planted if r == rate and there}
        assert len(got & wanted) >= least * len(wanted), rate


def test_copies_cut_at_either_end(spark):
    """Without answers an item counts by its share of words alone, wherever the rest of it was cut or reworded."""
    draw = random.Random(8)
    items = [(i, prose(draw, 40)) for i in range(60)]
    rows, wanted = [], set()
    for i, (number, item) in enumerate(items * 4):
        words, lost = item.split(), (6, 8, 10, 11)[i // 60]  # 15 to 27.5% of the words
        changed = [f"other{n}" for n in range(lost)]
        copy = (words[:-lost], words[lost:], words[:-lost] + changed, changed + words[lost:])[i % 4]
        rows.append((i, " ".join([*prose(draw, 60).split(), *copy, *prose(draw, 60).split()])))
        wanted.add((i, number))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op.contaminated(docs, bench).collect()}
    assert len(got & wanted) >= 0.97 * len(wanted)
    assert len(got - wanted) <= 3


def test_passages_of_the_fit_hold_every_word(spark):
    """Rows have length 1 and are cut into runs of two to four blocks, but for texts of one block, up to the last word."""
    texts = ["", None, "a", "b " * 16, "c " * 17, "d " * 64, "e " * 65, "f " * 1000, "g h g " * 40]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    idf = np.random.default_rng(1).random(op.TERMS).astype(np.float32) + 1
    got = sorted((sorted(r["terms"]), len(r["terms"])) for r in op.passage_rows(op.whole_texts(docs), idf).collect())
    term = {w: int(op.term_ids(split_words(pa.array([w])))[0]) for w in "abcdefgh"}
    counts = [(w, n) for w, n in (("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 2), ("f", 16))]
    wanted = [([term[w]], 1) for w, n in counts for _ in range(n)] + [(sorted([term["g"], term["h"]]), 2)] * 2
    assert got == sorted(wanted)
    for r in op.passage_rows(op.whole_texts(docs), idf).collect():
        assert np.linalg.norm(r["weights"]) == pytest.approx(1, abs=1e-5)
        if len(r["terms"]) == 2:
            weight = dict(zip(r["terms"], r["weights"]))
            assert weight[term["g"]] / weight[term["h"]] == pytest.approx(2 * idf[term["g"]] / idf[term["h"]], rel=0.1)


def test_every_document_enters_the_fit(spark, monkeypatch):
    """Documents beyond any sample count: the space is that of a dense decomposition over all of them."""
    monkeypatch.setattr(op, "SAMPLE_DOCS", 3)
    draw = random.Random(2)
    texts = [prose(draw, draw.choice([10, 90, 200])) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(0, prose(draw, 30))], "item_id long, text string")
    seen, plain = [], op.gram_product
    monkeypatch.setattr(op, "gram_product", lambda rows, factor: seen.append(rows.count()) or plain(rows, factor))
    table = op.latent_space(docs, bench, op.term_weights(docs))
    passages = sum(-(--(-len(t.split()) // op.BLOCK) // 4) for t in texts)
    assert seen == [passages, 1] * 2 and np.isfinite(table).all()
    for word in {w for t in texts for w in t.split()}:
        assert np.abs(table[op.term_ids(split_words(pa.array([word])))[0]]).max() > 0


def test_long_items_are_found(spark):
    """A passage cut out of a document meets the passages of an item that is many times as long."""
    draw = random.Random(4)
    long = prose(draw, 1500)
    texts = [" ".join([prose(draw, 40), long, prose(draw, 40)]), *(prose(draw, 1500) for _ in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(3, long), (4, prose(draw, 40))], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in op.contaminated(docs, bench).collect()] == [(0, 3)]


def test_packed_passages_are_the_same_rows(spark):
    draw = random.Random(6)
    texts = ["", None, "a", *(prose(draw, draw.choice([3, 17, 64, 400])) for _ in range(30))]
    docs = op.whole_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    idf = np.random.default_rng(1).random(op.TERMS).astype(np.float32) + 1
    plain, packed = op.passage_rows(docs, idf), op.passage_rows(docs, idf, packed=True)
    got = sorted((np.frombuffer(r["terms"], np.uint16).tolist(), np.frombuffer(r["weights"], np.float32).tolist())
                 for r in packed.collect())
    assert got == sorted((r["terms"], r["weights"]) for r in plain.collect())
    factor = np.random.default_rng(2).standard_normal((op.TERMS, 3))
    assert np.allclose(op.gram_product(packed, factor), op.gram_product(plain, factor), atol=1e-4)


def test_basis_by_ranges_is_one_and_small():
    """The basis spans the columns, also where rows or columns are empty, and takes little more than it holds."""
    tall = np.random.default_rng(0).standard_normal((op.TERMS, 24)).astype(np.float32)
    tall[: op.TERMS // 2] = 0
    tall[:, 3] = tall[:, 2]
    tracemalloc.start()
    basis = op.orthonormal(tall)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(basis.T @ basis, np.eye(24), atol=1e-5) and np.allclose(basis @ (basis.T @ tall), tall, atol=1e-4)
    assert peak < 2.5 * tall.nbytes


def test_shares_are_those_of_the_whole_subsequence():
    draw = random.Random(9)
    lists = [[draw.randint(1, 12) for _ in range(draw.randint(op.SHORT, 30))] for _ in range(40)]
    answers = [draw.sample(range(1, 12), draw.randint(0, 3)) for _ in lists]
    index = op.Index(list(range(40)), np.zeros((1, 1)), np.zeros((40, 1)), np.arange(40), lists, answers)
    seen = set()
    for item, (words, answer) in enumerate(zip(lists, answers)):
        for _ in range(20):
            text = [w for w in words if draw.random() < 0.85] + [draw.randint(1, 40) for _ in range(draw.randint(0, 30))]
            share = lcs(words, text) / len(words)
            there = share >= op.SHARE and lcs(answer, text) >= op.ANSWER * len(answer)
            assert index.share(item, np.array(text, np.uint64)) == (share if there else 0.0)
            seen.add(there)
    assert seen == {True, False}


def test_hashes_of_words_are_polynomials(monkeypatch):
    """Also in texts longer than the powers that are kept."""
    texts = pa.array(["Aa b\u00c9 " + "x" * 70 + " 9", None, "", "\u4e2d y,z " * 5])
    def plain(word):
        value = sum((b + 1) * pow(int(vectext.BASE), i, 1 << 64) for i, b in enumerate(word.encode())) % (1 << 64)
        return int(vectext.mixed(np.array([value], np.uint64))[0])
    words = [re.findall(r"\w+", (t or "").lower()) for t in texts.to_pylist()]
    for kept in (vectext.KEPT, 8):
        monkeypatch.setattr(vectext, "KEPT", kept)
        got = vectext.split_words(texts)
        assert got.hashes.tolist() == [plain(w) for doc in words for w in doc]
        assert np.diff(got.first).tolist() == [len(doc) for doc in words]
