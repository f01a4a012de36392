import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import rows
from orderlens.operators import forest, risk
from orderlens.session import scratch_path
from orderlens.sources import commerce


@pytest.fixture(scope="module")
def matrix(spark, small):
    star = commerce.star(spark, small)
    made = risk.with_label(risk.with_features(risk.training_set(star))).select(*forest.KEYS, *risk.FEATURES, risk.LABEL)
    path = scratch_path(spark, "matrix")
    made.write.parquet(path)
    return spark.read.parquet(path)


def grown_by_hand(data, shape, seed):
    """The same trees in plain Python from (keys, late, bins)."""
    def number(*parts):
        return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16)

    def purity(late, n):
        return (float(late) * late + float(n - late) * (n - late)) / n

    found = []
    for tree in range(1, shape.trees + 1):
        weighted = [(sum(number(*key, tree, seed) >= w for w in forest.WEIGHTS), late, bins) for key, late, bins in data]
        level = {1: [m for m in weighted if m[0]]}
        for depth in range(shape.depth + 1):
            below = defaultdict(list)
            for node, members in level.items():
                n, late = sum(w for w, _, _ in members), sum(w * y for w, y, _ in members)
                order = sorted((hashlib.md5(f"{tree}|{node}|{i}|{seed}".encode()).hexdigest(), i) for i in range(len(risk.FEATURES)))
                best = None
                for _, f in order[:shape.tried] if depth < shape.depth else []:
                    for cut in sorted({b[f] for _, _, b in members}):
                        nl = sum(w for w, _, b in members if b[f] <= cut)
                        ll = sum(w * y for w, y, b in members if b[f] <= cut)
                        if nl >= shape.min_leaf and n - nl >= shape.min_leaf:
                            g = purity(ll, nl) + purity(late - ll, n - nl)
                            if g > purity(late, n) and (best is None or (g, -f, -cut) > best):
                                best = (g, -f, -cut)
                found.append((tree, node, n, late, *((-best[1], -best[2]) if best else (None, None))))
                if best:
                    for m in members:
                        below[2 * node + (m[2][-best[1]] > -best[2])].append(m)
            level = below
    return found


@pytest.mark.parametrize("shape", [forest.Shape(3, 3), forest.Shape(2, 1, 4, 50, 13)])
def test_trees_and_scores_by_hand(matrix, shape):
    grown = forest.fit(matrix, shape, 7)
    data = [((r["order_id"], r["order_item_id"]), r["late"], r["bins"]) for r in forest.binned(
        matrix, grown.numbers, grown.categories, *forest.KEYS, F.col(risk.LABEL).alias("late")).collect()]
    nodes = grown_by_hand(data, shape, 7)
    assert sorted(rows(grown.nodes), key=repr) == sorted(nodes, key=repr)
    table = {(t, i): (f, b, late * forest.UNIT // n) for t, i, n, late, f, b in nodes}
    wanted = {}
    for key, _, bins in data:
        total = 0
        for tree in range(1, shape.trees + 1):
            node = 1
            while table[tree, node][0] is not None:
                node = 2 * node + (bins[table[tree, node][0]] > table[tree, node][1])
            total += table[tree, node][2]
        wanted[key] = total / (shape.trees * forest.UNIT)
    got = {(r[0], r[1]): r[2] for r in rows(forest.score(matrix, grown, *forest.KEYS))}
    assert got == wanted


def test_bins_hold_equal_shares_and_odd_values(spark, matrix):
    numbers, categories = forest.fit_bins(matrix, forest.Shape(bins=8))
    every = forest.binned(matrix, numbers, categories, "price").select("price", F.col("bins")[5].alias("b"))
    counts = sorted(r["count"] for r in every.groupBy("b").count().collect())
    assert 6 <= len(counts) <= 8 and counts[-1] < 2.5 * sum(counts) / 8
    odd = matrix.limit(1).withColumns({"price": F.lit(1e9), "customer_state": F.lit("nowhere"),
                                       "product_weight_g": F.lit(None).cast("double")})
    bins = forest.binned(odd, numbers, categories, "order_id").first()["bins"]
    assert bins[5] == 7 and bins[10] == -1 and bins[6] in (-1, 0)


def test_learns_and_survives_saving(spark, matrix):
    split = risk.stratified_split(matrix, forest.KEYS)
    grown = forest.fit(split.filter("NOT is_test").drop("is_test"), forest.Shape(16, 6))
    test = split.filter("is_test")
    scored = forest.score(test, grown, *forest.KEYS, risk.LABEL)
    assert risk.roc_auc(scored).first()[0] > 0.6
    folder = scratch_path(spark, "forest")
    forest.save(grown, folder)
    again = forest.score(test, forest.load(spark, folder), *forest.KEYS, risk.LABEL)
    assert sorted(rows(again)) == sorted(rows(scored))


def test_one_class_gives_single_leaves(matrix):
    grown = forest.fit(matrix.withColumn(risk.LABEL, F.lit(1)).limit(200), forest.Shape(2, 3))
    assert [r[1] for r in rows(grown.nodes)] == [1, 1]
    assert {r[0] for r in rows(forest.score(matrix.limit(20), grown))} == {1.0}
    with pytest.raises(ValueError):
        forest.fit(matrix, forest.Shape(depth=13))


def test_rows_are_not_copied_per_tree(matrix, monkeypatch):
    sizes, stored = {}, forest._stored

    def counted(frame, name):
        table = stored(frame, name)
        sizes.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(forest, "_stored", counted)
    forest.fit(matrix, forest.Shape(4, 2), 7)
    assert sizes["forest-members"] == [matrix.count()]
