import math

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import nearest as op
from orderlens.llm.queries import op11_nearest

SCHEMA = "vec_id long, embedding array<float>, label int"
def tenth():
    return F.col("vec_id") % 10 == 0


def cosine(a, b):
    dot = na = nb = 0.0
    for x, y in zip(a, b):
        dot, na, nb = dot + x * y, na + x * x, nb + y * y
    return max(-1.0, min(1.0, dot / math.sqrt(na * nb)))


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def by_hand(rows, every, k=5):
    rows = [(i, v) for i, v in rows if usable(v)]
    out = []
    for n, (q, vector) in enumerate(rows):
        if q is None or q % every:
            continue
        found = sorted((-cosine(vector, v), i is None, i or 0, i) for m, (i, v) in enumerate(rows)
                       if m != n and len(v) == len(vector))[:k]
        out += [(q, rank, i, -s) for rank, (s, _, _, i) in enumerate(found, 1)]
    return sorted(out, key=repr)


def ask(spark, rows, every=10, schema=SCHEMA, **how):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    values = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    return cases.plain(op.nearest(frame, F.col("vec_id") % every == 0, **how)), by_hand(values, every, how.get("k", 5))


def test_edge_cases(spark):
    odd = [None, [], [0.0, 0.0], [1.0, None], [1.0, float("nan")], [float("inf"), 1.0], [3.0], [-1e-30, 1e-30], [2.0, 0.0, 1.0],
           [1e38, 1e38], [1.0, 1.0], [-0.0, 1.0], [0.0, 1.0]]
    rows = [(10 * i, v, 0) for i, v in enumerate(odd)] + [(i, v, 1) for i, v in enumerate(odd, 1)] + [(None, [1.0, 1.0], 2)]
    got, wanted = ask(spark, rows + rows[:3])
    assert got == wanted
    assert op.nearest(spark.createDataFrame([], SCHEMA), tenth()).collect() == []
    assert op.nearest(spark.createDataFrame([(1, [1.0], 0)], SCHEMA), tenth()).collect() == []
    assert op.nearest(spark.createDataFrame([(0, [1.0], 0)], SCHEMA), tenth()).collect() == []  # no candidate but itself
    clash = spark.createDataFrame([(0, [1.0], 1, 2, 3, 4), (1, [2.0], 1, 2, 3, 4)],
                                  "vec_id long, embedding array<float>, row int, dims int, q int, score int")
    assert cases.plain(op.nearest(clash, tenth())) == [(0, 1, 1, 1.0)]


@pytest.mark.parametrize("how", [{}, {"block_bytes": 4096, "small_bytes": 2048}, {"k": 1}, {"k": 50}])
def test_clusters_ties_and_blocks(spark, how):
    """Near clusters that codes cannot tell apart, a vector that a third of all rows repeat, and equal scores."""
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(4, 16))
    vectors = [centres[i % 4] + draw.normal(size=16) * (0.5 if i % 2 else 1e-4) for i in range(300)]
    vectors += [centres[0] * 2.0 ** (i % 5) for i in range(150)]
    order = draw.permutation(450)
    rows = [(i, [float(x) for x in vectors[n]], 0) for i, n in enumerate(order)]
    got, wanted = ask(spark, rows, schema="vec_id long, embedding array<double>, label int", **how)
    assert got == wanted


@pytest.mark.parametrize("dims", [1, 7, 64, 1500])
def test_error_bounds_hold(dims):
    draw = np.random.default_rng(dims)
    left, right = (op.scaled(draw.normal(size=(40, dims)) * 10.0 ** draw.integers(-200, 200, (40, 1))) for _ in range(2))
    a, b = op.codes(left), op.codes(right)
    close = op.product(a[0], b[0]) * a[1][:, None] * b[1]
    off = a[3][:, None] + a[2][:, None] * b[3] + op.SLACK
    true = np.array([op.cosines(np.repeat(row[None], 40, axis=0), right) for row in left])
    assert (np.abs(close - true) <= off).all()
    assert (op.product(a[0], b[0]) == a[0].astype(np.int64) @ b[0].astype(np.int64).T).all()


def test_small_tiles_give_the_same(spark, monkeypatch):
    draw = np.random.default_rng(5)
    import pyarrow as pa
    table = pa.table({"vec_id": np.arange(400), "row": np.arange(400), "vector": list(draw.normal(size=(400, 8)))})
    block = op.Block(table)
    whole = [sorted(h) for h in op.search(block, block, 5)]
    monkeypatch.setattr(op, "TILE", 2048)
    assert [sorted(h) for h in op.search(block, block, 5)] == whole


def test_test_table(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert cases.plain(op11_nearest(spark, small)) == by_hand(rows, 50)
