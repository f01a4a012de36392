"""A random forest grown by aggregations, whose model is a table of nodes.

Rows are reduced to small bin numbers and their weight in every tree once. A level of all trees is then one pass over them:
every task walks its Arrow batches down the trees grown so far and counts into (tree, node, feature, bin) cells, the cells of
the tasks are summed, and running sums over a node's few bins give the impurity of every split. Rows are neither copied per
tree nor moved; only cells and nodes grow with the forest, and all counts are whole numbers, so any engine that is given the
table of nodes, or the rows, comes to the same trees and the same scores.
``risk`` fits the deep forest of ``pyspark.ml``; this one is for models that must be read, checked and moved as tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import e, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.operators.risk import CATEGORICAL, FEATURES, LABEL, NUMERIC, draw
from orderlens.session import scratch_path, shuffles_removed

KEYS = ["order_id", "order_item_id"]
#: Cells of the histogram that a number is binned by, and the deepest forest whose trees fit in an array.
CELLS, DEEPEST = 1024, 12
#: Scores of leaves are whole millionths.
UNIT = 1_000_000
#: A row's weight in a tree is how many of these its draw reaches: a bootstrap sample in expectation (Poisson, mean 1).
WEIGHTS = [int(2 ** 52 * sum(1 / factorial(j) for j in range(i + 1)) / e) for i in range(6)]
NODES = "tree int, node int, n bigint, late bigint, feature int, bin int"


@dataclass(frozen=True)
class Shape:
    trees: int = 8
    depth: int = 5
    bins: int = 32
    min_leaf: int = 5
    tried: int = 4


@dataclass(frozen=True)
class Forest:
    """Nodes (children of i are 2i and 2i + 1, ``bin`` and below go left), ranges of the numbers with the cells where bins
    begin, and the bins of the categories."""

    nodes: DataFrame
    numbers: DataFrame
    categories: DataFrame
    depth: int


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    with shuffles_removed(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _number(feature: str) -> Column:
    return F.col(feature).cast("double")


def _cell(value: Column, lo: Column, hi: Column) -> Column:
    """The cell of a number between the ends of its feature; -1 for NULL, the outer cells for what lies beyond."""
    place = F.floor((value - lo) * F.lit(float(CELLS)) / (hi - lo))
    inside = F.least(F.greatest(place, F.lit(0)), F.lit(CELLS - 1))
    return F.when(value.isNull(), -1).when(hi <= lo, 0).otherwise(inside).cast("int")


def fit_bins(rows: DataFrame, shape: Shape = Shape()) -> tuple[DataFrame, DataFrame]:
    """(feature, lo, hi, cells) of the numbers and (feature, value, bin) of the categories.

    Bins hold about equally many rows. Numbers are binned by a histogram of fixed size, categories in order of their late
    rate; both take one pass with map-side sums.
    """
    ends = rows.agg(*[F.struct(F.min(_number(c)).alias("lo"), F.max(_number(c)).alias("hi")).alias(c) for c in NUMERIC])
    ends = ends.first()  # one row
    long = rows.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("feature"), F.lit(ends[c]["lo"]).cast("double").alias("lo"),
                 F.lit(ends[c]["hi"]).cast("double").alias("hi"),
                 _cell(_number(c), F.lit(ends[c]["lo"]).cast("double"), F.lit(ends[c]["hi"]).cast("double")).alias("cell"))
        for i, c in enumerate(NUMERIC)])))
    cells = long.groupBy("feature", "lo", "hi", "cell").agg(F.count("*").alias("n"))
    of = Window.partitionBy("feature")  # CELLS + 1 rows

    def equal_shares(before: Window) -> Column:
        earlier = F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return F.floor(earlier * shape.bins / F.sum("n").over(of)).cast("int")

    numbers = (cells.withColumn("bin", equal_shares(of.orderBy("cell"))).groupBy("feature", "lo", "hi", "bin")
               .agg(F.min("cell").alias("cell")).groupBy("feature", "lo", "hi")
               .agg(F.array_sort(F.collect_list("cell")).alias("cells")))  # at most ``bins`` entries
    names = rows.select(LABEL, F.inline(F.array(*[F.struct(F.lit(len(NUMERIC) + i).alias("feature"), F.col(c).alias("value"))
                                                  for i, c in enumerate(CATEGORICAL)])))
    counts = names.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum(LABEL).alias("late"))
    by_rate = of.orderBy(F.col("late").cast("double") / F.col("n").cast("double"), "value")
    return numbers, counts.select("feature", "value", equal_shares(by_rate).alias("bin"))


def binned(rows: DataFrame, numbers: DataFrame, categories: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``bins``, one small number per feature; a category that was never seen is -1."""
    ranges = {r["feature"]: r for r in numbers.collect()}  # one row per number
    bins = []
    for i, name in enumerate(NUMERIC):
        r = ranges[i]
        cell = _cell(_number(name), F.lit(r["lo"]).cast("double"), F.lit(r["hi"]).cast("double"))
        of_cell = np.searchsorted(r["cells"], np.arange(-1, CELLS), side="right") - 1
        bins.append(F.get(F.split(F.lit(",".join(map(str, of_cell))), ",").cast("array<int>"), cell + 1))
    for i, name in enumerate(CATEGORICAL):
        known = categories.filter(F.col("feature") == len(NUMERIC) + i).select(F.col("value").alias(name),
                                                                              F.col("bin").alias(f"_b{i}"))
        rows = rows.join(known, name, "left")
        bins.append(F.coalesce(F.col(f"_b{i}"), F.lit(-1)))
    return rows.select(*keep, F.array(*bins).alias("bins"))


def _tried(shape: Shape, seed: int) -> Column:
    """The features that a node may split by: the first in an order drawn for the node."""
    drawn = [F.struct(F.md5(F.concat_ws("|", "tree", "node", F.lit(i), F.lit(seed))).alias("u"), F.lit(i).alias("feature"))
             for i in range(len(FEATURES))]
    return F.transform(F.slice(F.array_sort(F.array(*drawn)), 1, shape.tried), lambda d: d["feature"])


def _listed(column: pa.Array) -> np.ndarray:
    """An Arrow column of equally long lists of whole numbers, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class _Trees:
    """Split feature (-1: none) and bin of every node of every tree by number, and where a row with given bins ends."""

    def __init__(self, depth: int, trees: Iterable[int]):
        self.depth = depth
        self.feature = {tree: np.full(2 ** (depth + 1), -1, np.int32) for tree in trees}
        self.bin = {tree: np.zeros(2 ** (depth + 1), np.int32) for tree in trees}

    def add(self, rows: Iterable) -> None:
        for r in rows:
            if r["feature"] is not None:
                self.feature[r["tree"]][r["node"]], self.bin[r["tree"]][r["node"]] = r["feature"], r["bin"]

    def ends(self, tree: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of every row after at most ``levels`` steps."""
        at, flat, place = np.ones(len(bins), np.int64), bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        for _ in range(levels):
            feature = self.feature[tree][at]
            beyond = flat[place + np.maximum(feature, 0)] > self.bin[tree][at]
            at = np.where(feature < 0, at, 2 * at + beyond)
        return at


CELL_COUNTS = "tree int, node int, feature int, bin int, w bigint, l bigint"


def cell_counts(members: DataFrame, grown: _Trees, level: int, asked: dict[tuple[int, int], list[int]],
                shape: Shape) -> DataFrame:
    """(tree, node, feature, bin, w, l): weight and late weight of the rows in the cells of a level's nodes. ``members`` has
    late, bins and weights (one per tree), ``asked`` the features each node may split by."""
    first, width, tried = 2 ** level, shape.bins + 1, max(map(len, asked.values()), default=0)
    features = {tree: np.full((first, tried), -1, np.int32) for tree in grown.feature}
    for (tree, node), some in asked.items():
        features[tree][node - first] = some
    shared = members.sparkSession.sparkContext.broadcast((grown, features))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, features = shared.value
        sums = {tree: np.zeros((2, first * tried * width), np.int64) for tree in features}
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, weights = _listed(batch.column("bins")), _listed(batch.column("weights"))
            late = batch.column("late").to_numpy()
            for n, tree in enumerate(sorted(features)):
                of = np.flatnonzero(weights[:, n])
                node = grown.ends(tree, bins[of], level) - first
                of, node = of[node >= 0], node[node >= 0]
                w, y = weights[of, n].astype(np.float64), weights[of, n] * late[of].astype(np.float64)
                for j in range(tried):
                    feature = features[tree][node, j]
                    known = feature >= 0
                    cell = ((node * tried + j) * width + bins[of, np.maximum(feature, 0)] + 1)[known]
                    for side, x in enumerate((w, y)):
                        sums[tree][side] += np.bincount(cell, x[known], sums[tree].shape[1]).astype(np.int64)
        for tree, (w, y) in sums.items():
            cell = np.flatnonzero(w)
            node, j = cell // (tried * width), cell // width % tried
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array(np.full(len(cell), tree, np.int32)), "node": pa.array((node + first).astype(np.int32)),
                "feature": pa.array(features[tree][node, j]), "bin": pa.array((cell % width - 1).astype(np.int32)),
                "w": pa.array(w[cell]), "l": pa.array(y[cell])})

    return (members.select("late", "bins", "weights").mapInArrow(count, CELL_COUNTS).groupBy("tree", "node", "feature", "bin")
            .agg(F.sum("w").alias("w"), F.sum("l").alias("l")))


def _purity(late: Column, n: Column) -> Column:
    """Rows times the chance that two of them are alike: a split is best where the sum over both sides is largest."""
    late, n = late.cast("double"), n.cast("double")
    return (late * late + (n - late) * (n - late)) / n


def best_splits(cells: DataFrame, shape: Shape) -> DataFrame:
    """(tree, node, n, late, feature, bin, n_left, late_left) for every node of a level; a node that stays a leaf has no
    feature. ``cells`` are those of ``cell_counts``."""
    of_feature = cells.groupBy("tree", "node", "feature").agg(F.sum("w").alias("n"), F.sum("l").alias("late"))
    asked = of_feature.groupBy("tree", "node").agg(F.max("n").alias("n"), F.max("late").alias("late"))  # all features agree
    up_to = Window.partitionBy("tree", "node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = cells.select("tree", "node", "feature", "bin", F.sum("w").over(up_to).alias("n_left"),
                         F.sum("l").over(up_to).alias("late_left")).join(asked, ["tree", "node"])
    n_right, late_right = F.col("n") - F.col("n_left"), F.col("late") - F.col("late_left")
    valid = sides.filter((F.col("n_left") >= shape.min_leaf) & (n_right >= shape.min_leaf))
    gained = valid.withColumn("g", _purity(F.col("late_left"), F.col("n_left")) + _purity(late_right, n_right)).filter(
        F.col("g") > _purity(F.col("late"), F.col("n")))
    best = gained.groupBy("tree", "node").agg(F.max_by(
        F.struct("feature", "bin", "n_left", "late_left"), F.struct("g", -F.col("feature"), -F.col("bin"))).alias("s"))
    return asked.join(best, ["tree", "node"], "left").select("tree", "node", "n", "late", "s.feature", "s.bin", "s.n_left",
                                                              "s.late_left")


def fit(rows: DataFrame, shape: Shape = Shape(), seed: int = 42, keys: list[str] = KEYS) -> Forest:
    """Grows the forest on ``rows`` with the features of the risk model, the label and ``keys``, which give the draws."""
    if shape.depth > DEEPEST:
        raise ValueError(f"a forest that is scored as arrays has {DEEPEST} levels at most")
    spark = rows.sparkSession
    rows = _stored(rows.select(*keys, *FEATURES, LABEL), "forest-rows")
    numbers, categories = (_stored(t, "forest-bins") for t in fit_bins(rows, shape))
    drawn = F.array(*[draw([*keys, F.lit(tree)], seed) for tree in range(1, shape.trees + 1)])
    weights = F.transform(drawn, lambda u: sum(((u >= w).cast("int") for w in WEIGHTS), F.lit(0)))
    members = _stored(binned(rows, numbers, categories, F.coalesce(LABEL, F.lit(0)).alias("late"), weights.alias("weights")), "forest-members")
    grown, levels = _Trees(shape.depth, range(1, shape.trees + 1)), []
    nodes = [(tree, 1) for tree in range(1, shape.trees + 1)]
    for level in range(shape.depth):
        tried = spark.createDataFrame(nodes, "tree int, node int").select("tree", "node", _tried(shape, seed).alias("tried"))
        asked = {(r["tree"], r["node"]): r["tried"] for r in tried.collect()}  # the nodes of a level
        splits = _stored(best_splits(cell_counts(members, grown, level, asked, shape), shape), "forest-splits")
        levels.append(splits.select("tree", "node", "n", "late", "feature", "bin"))
        split = splits.filter("feature IS NOT NULL")
        if level + 1 == shape.depth:
            left = F.struct((2 * F.col("node")).alias("node"), F.col("n_left").alias("n"), F.col("late_left").alias("late"))
            right = F.struct((2 * F.col("node") + 1).alias("node"), (F.col("n") - F.col("n_left")).alias("n"),
                             (F.col("late") - F.col("late_left")).alias("late"))
            last = split.select("tree", F.inline(F.array(left, right)))
            levels.append(last.select("*", F.lit(None).cast("int").alias("feature"), F.lit(None).cast("int").alias("bin")))
            break
        found = split.select("tree", "node", "feature", "bin").collect()  # the nodes of a level
        grown.add(found)
        nodes = [(r["tree"], 2 * r["node"] + side) for r in found for side in (0, 1)]
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionByName(more)
    return Forest(_stored(nodes, "forest-nodes"), numbers, categories, shape.depth)


def score(rows: DataFrame, forest: Forest, *keep: str) -> DataFrame:
    """The kept columns and ``late_probability``: the mean over the trees of the late share in the row's leaf, in whole
    millionths. A tree is an array by node number, so the rows of an Arrow batch find their leaves in ``depth`` steps and
    nothing is shuffled but what the categories need."""
    nodes = forest.nodes.withColumn("score", F.floor(F.col("late") * UNIT / F.col("n")).cast("bigint")).collect()  # one model
    trees = sorted({r["tree"] for r in nodes})
    grown, scores = _Trees(forest.depth, trees), {tree: np.zeros(2 ** (forest.depth + 1), np.int64) for tree in trees}
    grown.add(nodes)
    for r in nodes:
        scores[r["tree"]][r["node"]] = r["score"]
    shared = rows.sparkSession.sparkContext.broadcast((grown, scores))

    @F.arrow_udf("bigint")
    def total(bins: pa.Array) -> pa.Array:
        grown, scores = shared.value
        matrix = _listed(bins) if len(bins) else np.empty((0, len(FEATURES)), np.int32)
        return pa.array(sum((scores[tree][grown.ends(tree, matrix, grown.depth)] for tree in scores),
                            np.zeros(len(bins), np.int64)))

    ready = binned(rows, forest.numbers, forest.categories, *keep)
    return ready.select(*keep, (total("bins").cast("double") / F.lit(float(len(trees) * UNIT))).alias("late_probability"))


def save(forest: Forest, folder: str) -> None:
    """Three small tables under a new folder."""
    forest.nodes.withColumn("depth", F.lit(forest.depth)).write.parquet(f"{folder}/nodes")
    forest.numbers.write.parquet(f"{folder}/numbers")
    forest.categories.write.parquet(f"{folder}/categories")


def load(spark: SparkSession, folder: str) -> Forest:
    nodes = spark.read.parquet(f"{folder}/nodes")
    return Forest(nodes.drop("depth"), spark.read.parquet(f"{folder}/numbers"), spark.read.parquet(f"{folder}/categories"),
                  nodes.agg(F.max("depth")).first()[0])
