import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import rows
from orderlens.operators import risk, trees


@pytest.fixture(scope="module")
def fitted(spark):
    """A deep forest over numbers and one-hot categories, on labels that leave much noise."""
    frame = spark.range(3000).selectExpr(
        "id", "double(hash(id) % 97) AS a", "double(id % 13) / 7 AS b", "concat('k', id % 6) AS c",
        "double(hash(id, 1) % 5 + id % 6 > 3) AS label").coalesce(1)
    stages = [StringIndexer(inputCol="c", outputCol="i"), OneHotEncoder(inputCol="i", outputCol="v"),
              VectorAssembler(inputCols=["a", "b", "v"], outputCol="features"),
              RandomForestClassifier(numTrees=12, maxDepth=30, minInstancesPerNode=3, seed=1)]
    return Pipeline(stages=stages).fit(frame), frame


def test_probabilities_are_the_models_own(spark, fitted):
    model, frame = fitted
    own = model.transform(frame).select("id", vector_to_array("probability")[1].alias("p"))
    walked = risk.with_probability(model, frame, "q").select("id", "q")
    both = own.join(walked, "id")
    assert both.count() == 3000 and both.filter("p != q").count() == 0
    assert both.select("q").distinct().count() > 100


def test_rows_are_not_walked_one_by_one_in_the_jvm(fitted):
    """Failed before: the plan held the model's own row function."""
    model, frame = fitted
    plan = risk.with_probability(model, frame, "q")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan


def test_no_rows_and_values_not_seen(spark, fitted):
    forest = fitted[0].stages[-1]
    size = forest.numFeatures
    odd = [[float("inf")] + [0.0] * (size - 1), [float("nan")] * 2 + [0.0] * (size - 2), [-1e300, 1e300] + [0.0] * (size - 2)]
    frame = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(odd)], ["id", "features"])
    own = rows(forest.transform(frame).orderBy("id").select(vector_to_array("probability")[1]))
    column = trees.probability(spark, forest)
    assert rows(frame.orderBy("id").select(column)) == own
    assert rows(frame.filter("id < 0").select(column)) == []


def test_features_of_many_categories_are_left_to_the_model(spark):
    frame = spark.range(600).selectExpr("id", "concat('k', id % 9) AS c", "double(id % 9 IN (1, 4, 7)) AS label")
    model = Pipeline(stages=[StringIndexer(inputCol="c", outputCol="i"), VectorAssembler(inputCols=["i"], outputCol="features"),
                             RandomForestClassifier(numTrees=3, seed=1)]).fit(frame)
    assert trees.probability(spark, model.stages[-1]) is None
    scored = risk.with_probability(model, frame, "q").select("label", "q")
    assert scored.filter("(q > 0.5) != (label = 1)").count() == 0


def test_a_tree_that_is_one_leaf(spark):
    frame = spark.createDataFrame([(Vectors.dense([1.0]), float(i % 2)) for i in range(10)], ["features", "label"])
    model = RandomForestClassifier(numTrees=2, seed=1).fit(frame)
    walk = trees.walk_of(spark, model)
    own = [r[0] for r in rows(model.transform(frame).select(vector_to_array("probability")[1]))]
    assert list(trees.probabilities(walk, np.ones((10, 1)))[1]) == own


def test_learners_get_the_drawn_rows_from_a_table_of_their_own(spark, small, tmp_path):
    """Beyond the bound the learners no longer pass over the whole table."""
    from orderlens.sources import commerce
    size = risk.ForestSize(trees=2, depth=3, fitting_rows=500)
    trained = risk.train(spark, commerce.star(spark, small), str(tmp_path), size)
    assert isinstance(trained.model, PipelineModel) and trained.metrics.count() == 2
    drawn = risk.scores(trained.models["random_forest"], trained.test)
    assert drawn.filter(F.col("late_probability").between(0, 1)).count() == trained.test.count() > 0
