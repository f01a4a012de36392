import numpy as np
import pytest

from helpers import rows
from orderlens.operators import retrieval, vector_index
from orderlens.session import scratch_path


def frame(spark, ids, vectors):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)],
                                 "id bigint, embedding array<float>")


def clustered(n=600, dims=12, seed=2):
    """Six far clusters, a third of all rows copies of one vector, a zero vector."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dims)) * 4
    vectors = centres[np.arange(n) % 6] + draw.normal(size=(n, dims)) * 0.3
    vectors[::3] = vectors[0]
    vectors[5] = 0
    return draw.permutation(n), vectors


@pytest.mark.parametrize("pivots,block_rows", [(32, 1024), (8, 16), (2, 7), (600, 1)])
@pytest.mark.parametrize("others", [False, True])
def test_same_rows_as_the_full_search(spark, pivots, block_rows, others):
    ids, vectors = clustered()
    table = frame(spark, ids, vectors).repartition(3)
    index = vector_index.build_index(table, scratch_path(spark, "index"), pivots, block_rows)
    asked = table.filter("id % 7 = 0")
    want = sorted(rows(retrieval.top_k(asked, table, 4, others)))
    assert sorted(rows(vector_index.top_k(index, asked, 4, others))) == want
    assert sorted(rows(vector_index.top_k(index, asked, 4, others, broadcast_bytes=10))) == want


def test_bounds_exclude_other_clusters(spark):
    ids, vectors = clustered()
    folder = scratch_path(spark, "index")
    table = frame(spark, ids, vectors)
    vector_index.build_index(table, folder, 24, 16)
    index = vector_index.open_index(spark, folder)
    asked = table.filter("id % 50 = 0")
    (row,) = rows(vector_index.pruning(index, asked))
    n = asked.filter("exists(embedding, x -> x <> 0)").count()
    assert row[:3] == (n, 599, n * 599)
    assert 0 < row[3] < 0.6 * n * 599
    plan = vector_index.top_k(index, asked.limit(1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan and "Exchange hashpartitioning(id" not in plan


def test_bounds_never_exclude_an_answer():
    draw = np.random.default_rng(4)
    unit = retrieval._unit(draw.normal(size=(500, 5)) + np.repeat(draw.normal(size=(5, 5)) * 2, 100, axis=0))
    index = vector_index.VectorIndex(None, None, np.arange(10), unit[:10])
    far = vector_index.distances(unit, unit[:10])
    cell = far.argmin(axis=1)
    asked = vector_index.Questions(np.arange(500), unit, index, 4, True)
    similar = unit @ unit.T
    np.fill_diagonal(similar, -2)
    best = np.argsort(-similar, axis=1)[:, :4]
    for c in range(10):
        of = np.flatnonzero(cell == c)
        may = asked.may_hold(c, far[of, c], far[of, c])
        for q in range(500):
            assert set(best[q]) & set(of) <= set(of[may[q]])


def test_odd_vectors_and_empty_tables(spark):
    odd = frame(spark, range(6), [None, [0, 0], [1, 0], [float("nan"), 1], [0, 2], [1, 1]])
    index = vector_index.build_index(odd, scratch_path(spark, "index"))
    assert sorted(rows(vector_index.top_k(index, odd.filter("id IN (0, 1, 2, 3)"), 2))) == [(2, 1, 2, 1.0), (2, 2, 5, 0.707)]
    empty = vector_index.build_index(odd.filter("id < 2"), scratch_path(spark, "index"))
    assert rows(vector_index.top_k(empty, odd)) == []
    assert rows(vector_index.pruning(empty, odd.filter("id = 2"))) == [(1, 0, 0, 0)]
    assert rows(vector_index.top_k(index, odd.filter("id > 9"))) == []


def test_pruning_counts_every_pair_however_many_questions_there_are(spark):
    """Failed before: with more questions than a broadcast holds, all pairs were given as looked at."""
    ids, vectors = clustered()
    table = frame(spark, ids, vectors)
    index = vector_index.build_index(table, scratch_path(spark, "index"), 24, 16)
    asked = table.filter("id % 7 = 0").repartition(3)
    together = rows(vector_index.pruning(index, asked))
    assert together[0][3] < together[0][2]
    assert rows(vector_index.pruning(index, asked, broadcast_bytes=8 * 12 * 30)) == together
