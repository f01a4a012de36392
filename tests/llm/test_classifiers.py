import zlib

import cases
import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import linear, quality, toxicity, vectext


def words_by_hand(text):
    out, word = [], bytearray()
    for b in [*(text or "").encode(), 32]:
        if b >= 128 or chr(b).isalnum():
            word.append(b + 32 if 65 <= b <= 90 else b)
        elif word:
            out.append(bytes(word))
            word = bytearray()
    return out


def test_words_of_a_batch():
    texts = ["Hello, hello WORLD", None, "", "x", "é É", "hello", "y" * 500 + " z", "!?"]
    found = vectext.split_words(pa.array(texts).slice(0))
    counts = [len(words_by_hand(t)) for t in texts]
    assert np.diff(found.first).tolist() == counts
    by_word = {}
    for word, h in zip([w.replace(b"\xc3\x89", b"\xc3\xa9") for t in texts for w in words_by_hand(t)], found.hashes.tolist()):
        by_word.setdefault(word, set()).add(h)
    assert all(len(h) == 1 for h in by_word.values())
    assert len(set.union(*by_word.values())) == len(by_word)
    again = vectext.split_words(pa.array(["zz", *texts]).slice(1))
    assert again.hashes.tolist() == found.hashes.tolist()


def test_ordinal_model_learns_grades():
    draw = np.random.default_rng(0)
    level = draw.integers(0, 4, 900)
    columns = np.concatenate([np.append(draw.integers(100, 160, 5), [k] * int(k > 0)) for k in level])
    first = np.concatenate(([0], np.cumsum(5 + (level > 0))))
    rows = linear.Sparse(first, columns, np.ones(len(columns)))
    weights, thresholds = toxicity.fit_ordinal(rows, level, penalty=1e-4)
    assert (np.diff(thresholds) >= 0).all()
    severity = toxicity.Model(weights, thresholds, 0.0).severity(rows)
    means = [severity[level == k].mean() for k in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 2
    assert 0 <= severity.min() and severity.max() <= toxicity.GRADES


def test_ordinal_gradient_is_the_slope_of_the_likelihood():
    """above + beyond - 1 is the derivative of the negative log likelihood in the margin."""
    edges = np.array([-np.inf, -0.3, 0.4, 1.2, np.inf])
    for grade in range(4):
        def loss(f):
            return -np.log(linear.sigmoid(f - edges[grade]) - linear.sigmoid(f - edges[grade + 1]))

        slope = linear.sigmoid(0.2 - edges[grade]) + linear.sigmoid(0.2 - edges[grade + 1]) - 1
        assert slope == pytest.approx((loss(0.2 + 1e-6) - loss(0.2 - 1e-6)) / 2e-6, abs=1e-6)


def test_best_cut():
    severity, toxic = np.array([0.1, 0.9, 0.4, 0.8, 0.2]), np.array([False, True, False, True, False])
    assert toxicity.best_cut(severity, toxic) == pytest.approx(0.6)
    assert toxicity.best_cut(severity, ~toxic & False) == toxicity.GRADES


def test_dual_coordinate_descent_reaches_the_primal_optimum():
    """At the optimum the weights are the sum of dual variables, and no small step lowers the primal loss."""
    draw = np.random.default_rng(2)
    dense = draw.normal(size=(120, 6))
    sign = np.where(dense @ [1, -2, 0.5, 0, 0, 1] + 0.3 * draw.normal(size=120) > 0, 1.0, -1.0)
    rows = linear.Sparse(np.arange(0, 721, 6), np.tile(np.arange(6), 120), dense.ravel())
    solved = quality.dual_coordinate_descent(rows, sign, np.full(120, 0.5), epochs=500)
    x = np.hstack((dense, np.ones((120, 1))))

    def loss(w):
        return 0.5 * w @ w + 0.5 * np.maximum(0, 1 - sign * (x @ w)).sum()

    w = np.append(solved[:6], solved[-1])
    assert all(loss(w) <= loss(w + 0.02 * draw.normal(size=7)) + 1e-3 for _ in range(200))


def test_platt_orders_and_calibrates():
    margin = np.linspace(-3, 3, 600)
    good = np.random.default_rng(4).random(600) < linear.sigmoid(2 * margin + 0.5)
    slope, offset = quality.platt(margin, good)
    assert slope == pytest.approx(2, abs=0.5) and offset == pytest.approx(0.5, abs=0.4)


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_quality(spark, tables):
    docs, labels = tables
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.97


def test_quality_learns_from_allowed_rows_only(spark, tables):
    """Labels of held-out rows can be anything without a change of the model."""
    docs, labels = tables
    other = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id AS string)), 4) = 2, 1 - quality, quality) AS quality")
    a, b = quality.fit(docs, labels, 500), quality.fit(docs, other, 500)
    assert np.array_equal(a.weights, b.weights) and (a.slope, a.offset) == (b.slope, b.offset)


def test_held_out_toxicity(spark, tables):
    docs, labels = tables
    learn = labels.filter("doc_id % 3 <> 0")
    model = toxicity.fit(docs, learn)
    toxic = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, model).collect()}
    held = [(toxic[r["doc_id"]], r["toxic"] == 1) for r in labels.filter("doc_id % 3 = 0").collect()]
    hits = sum(a and b for a, b in held)
    assert hits / sum(b for _, b in held) > 0.85 and hits / sum(a for a, _ in held) > 0.85
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, t in toxic.items() if not t}


@pytest.mark.parametrize("op", [quality, toxicity])
def test_edge_cases(spark, op):
    docs = cases.documents(spark)
    label = "quality" if op is quality else "toxic"
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 1), (3, 1, 0), (4, None, 1), (None, 1, 1), (9, 0, 1), (9, 1, 1),
                                    (77, 1, 1), (7, 0, 0), (12, 1, 0), (13, 0, 0)], f"doc_id long, {label} int, text int")
    for known in (labels, labels.limit(0), labels.filter(f"{label} = 1")):
        model = op.fit(docs, known)
        got = op.score(docs, model).collect()
        assert len(got) == len(cases.rows())
        assert sorted((r["doc_id"] for r in got), key=repr) == sorted((r[0] for r in cases.rows()), key=repr)
    empty = op.fit(cases.empty(spark), labels.limit(0))
    assert op.score(cases.empty(spark), empty).collect() == []
    if op is toxicity:
        assert toxicity.drop_toxic(docs, model).columns == docs.columns
