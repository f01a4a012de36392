"""Late-delivery risk: training set, features, split, preprocessing, two models, evaluation, selection, persistence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.functions.measures import count_where
from orderlens.functions.percentiles import exact_percentile
from orderlens.operators import trees
from orderlens.operators.quality import forbidden_features
from orderlens.operators.star import UNKNOWN, days_between
from orderlens.session import scratch_path, shared_folder, shuffles_removed
from orderlens.sources.star import Star

# The features of the model, and the columns that must never be among them.
NUMERIC = ["purchase_month", "purchase_hour", "purchase_dow", "estimated_lead_days", "freight_value", "price",
           "product_weight_g", "length_cm", "height_cm", "width_cm"]
CATEGORICAL = ["customer_state", "product_category_en", "seller_state"]
FEATURES = NUMERIC + CATEGORICAL
FORBIDDEN = {"customer_delivery_ts", "delivery_days", "review_score", "is_delivered", "is_on_time", "order_status",
             "approved_ts", "carrier_delivery_ts"}
LABEL = "is_late"
# Fixed value: the probability from which an order is flagged.
FLAG_FROM = 0.30


def training_set(star: Star) -> DataFrame:
    """Delivered items with what was known at the purchase, the item's key, and the outcome."""
    forbidden_features(FEATURES, FORBIDDEN)
    fact = star.fact_orders.filter("is_delivered AND is_on_time IS NOT NULL").select(
        "order_id", "order_item_id", "customer_id", "product_id", "seller_id", "purchase_ts", "estimated_delivery_ts",
        "freight_value", "price", "is_on_time")
    products = star.dim_products.select("product_id", "product_category_en", "product_weight_g", "length_cm",
                                        "height_cm", "width_cm")
    # The products come last: their columns are the widest, and every join may move the rows once more.
    return (fact.join(star.dim_customers.select("customer_id", "customer_state"), "customer_id")
            .join(star.dim_sellers.select("seller_id", "seller_state"), "seller_id").join(products, "product_id")
            .select("order_id", "order_item_id", "purchase_ts", "estimated_delivery_ts", "freight_value", "price",
                    "is_on_time", "customer_state", "product_category_en", "product_weight_g", "length_cm",
                    "height_cm", "width_cm", "seller_state"))


def with_features(rows: DataFrame) -> DataFrame:
    """Calendar features (Monday is 0), the promised lead time to one decimal (half-even), no NULL category."""
    lead = days_between(F.col("purchase_ts"), F.col("estimated_delivery_ts"))
    derived = (rows.withColumn("purchase_month", F.month("purchase_ts"))
               .withColumn("purchase_hour", F.hour("purchase_ts"))
               .withColumn("purchase_dow", F.weekday("purchase_ts"))
               .withColumn("estimated_lead_days", F.bround(lead, 1)))
    return derived.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in CATEGORICAL})


def with_label(rows: DataFrame) -> DataFrame:
    return rows.withColumn(LABEL, (~F.col("is_on_time")).cast("int"))


def draw(keys: list[str | Column], seed: int) -> Column:
    """A number in [0, 2**52) that depends only on the row's key and the seed, not on partitions or retries."""
    text = F.concat_ws("|", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def stratified_cuts(rows: DataFrame, keys: list[str], test_share: float = 0.20, seed: int = 42,
                    label: str = LABEL) -> DataFrame:
    """(label, cut): the draw up to which a row of the class is test data; an exact distributed percentile."""
    drawn = rows.select(label, draw(keys, seed).alias("_u"))
    return exact_percentile(drawn, [label], "_u", test_share, 2 ** 16, name="cut")


def is_test(keys: list[str], seed: int, cut_late: Column, cut_on_time: Column, label: str = LABEL) -> Column:
    return draw(keys, seed).cast("double") <= F.when(F.col(label) == 1, cut_late).otherwise(cut_on_time)


def stratified_split(rows: DataFrame, keys: list[str], test_share: float = 0.20, seed: int = 42,
                     label: str = LABEL) -> DataFrame:
    """Adds ``is_test``: exactly the given share (to one row) of each class is test, chosen by a hash of the key.

    Both parts have the same late rate. Pass the item's key to split items, or only ``order_id`` to keep the items of an
    order together.
    """
    def cut(value: int) -> Column:
        return F.max(F.when(F.col(label) == value, F.col("cut")))

    cuts = stratified_cuts(rows, keys, test_share, seed, label)
    both = cuts.agg(F.struct(cut(1).alias("late"), cut(0).alias("on_time"))).scalar()
    return rows.withColumn("is_test", is_test(keys, seed, both["late"], both["on_time"], label))


def split_of_stored(stored: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """``stratified_split`` of a stored table: the cuts are found once, by passes over the table, and every later scan only
    compares with them."""
    cuts = {r[LABEL]: r["cut"] for r in stratified_cuts(stored, keys, seed=seed).collect()}  # one row per class
    late, on_time = (F.lit(cuts.get(value)).cast("double") for value in (1, 0))
    return stored.withColumn("is_test", is_test(keys, seed, late, on_time))


def medians(rows: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians of all columns from one long frame; a column without values gets 0."""
    long = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                          for c in columns])))
    found = exact_percentile(long, ["feature"], "value", 0.5, name="median").collect()  # one row per column
    return {c: 0.0 for c in columns} | {r["feature"]: r["median"] for r in found}


def fit_preprocessing(train: DataFrame) -> PipelineModel:
    """Median imputation and standard scaling of numbers, one-hot categories (an unseen one is all zeros)."""
    centre = medians(train, NUMERIC)
    filled = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), CAST({centre[c]!r} AS DOUBLE)) AS {c}_f" for c in NUMERIC)
    indexed, encoded = [f"{c}_i" for c in CATEGORICAL], [f"{c}_v" for c in CATEGORICAL]
    return Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}_f" for c in NUMERIC], outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
    ]).fit(train)


@dataclass(frozen=True)
class ForestSize:
    """Trees and smallest leaf; the depth is the deepest Spark allows, in effect none.

    ``memory_mb`` is the room for split statistics in every task: more of it means fewer passes over the rows. The models
    are fitted on all training rows; only a caller that sets ``fitting_rows`` gets a fit on that many of them (chosen by a
    hash of the key, so a rerun chooses the same). No named query does.
    """

    trees: int = 200
    depth: int = 30
    min_leaf: int = 5
    memory_mb: int = 256
    fitting_rows: int | None = None


def _logistic(rows: int) -> LogisticRegression:
    """A penalty weight of 1 on the summed loss; Spark minimises the mean loss, hence 1/n."""
    return LogisticRegression(regParam=1.0 / max(rows, 1), elasticNetParam=0.0, maxIter=1000, standardization=False)


def fit_models(train: DataFrame, forest: ForestSize = ForestSize(), seed: int = 42) -> dict[str, PipelineModel]:
    """Both candidates on one shared preprocessing. The classes are not reweighted: probabilities must stay honest."""
    prep = fit_preprocessing(train)
    rows = train.count()
    fitted = train
    if forest.fitting_rows is not None and rows > forest.fitting_rows:
        # The learners pass over their rows many times, in as many tasks as these have files: they are stored apart, so a
        # pass does not grow with the table.
        path = scratch_path(train.sparkSession, "fitting")
        train.filter(draw(["order_id", "order_item_id"], seed + 1) < int(2 ** 52 * forest.fitting_rows / rows)).select(
            *FEATURES, LABEL).write.parquet(path)
        fitted, rows = train.sparkSession.read.parquet(path), forest.fitting_rows
    ready = prep.transform(fitted).select("features", F.col(LABEL).cast("double").alias("label"))
    candidates = {
        "logistic_regression": _logistic(rows),
        "random_forest": RandomForestClassifier(numTrees=forest.trees, maxDepth=forest.depth,
                                                minInstancesPerNode=forest.min_leaf, featureSubsetStrategy="sqrt",
                                                maxMemoryInMB=forest.memory_mb, cacheNodeIds=True,
                                                checkpointInterval=10, seed=seed),
    }
    return {name: PipelineModel(stages=[*prep.stages, learner.fit(ready)]) for name, learner in candidates.items()}


def fit_logistic(train: DataFrame) -> PipelineModel:
    """The logistic candidate alone, on its own preprocessing."""
    prep = fit_preprocessing(train)
    learner = _logistic(train.count())
    return PipelineModel(stages=[*prep.stages, learner.fit(prep.transform(train).withColumn(
        "label", F.col(LABEL).cast("double")).select("features", "label"))])


def with_probability(model: PipelineModel, rows: DataFrame, name: str = "late_probability") -> DataFrame:
    """The rows, what the model's stages add, and the late probability. A forest's trees are walked by batches of rows, with
    the probabilities the model gives itself."""
    learner = model.stages[-1]
    late = trees.probability(rows.sparkSession, learner) if isinstance(learner, RandomForestClassificationModel) else None
    if late is None:
        return model.transform(rows).withColumn(name, vector_to_array("probability")[1])
    return PipelineModel(stages=model.stages[:-1]).transform(rows).withColumn(name, late)


def scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Label and late probability of every row, with the item's key."""
    return with_probability(model, rows).select("order_id", "order_item_id", LABEL, "late_probability")


#: Score ranges of the area: running sums go over these, then over the distinct scores inside one.
AREA_BUCKETS = 4096


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row, roc_auc: the exact area under the ROC curve, NULL without both classes.

    The share of (late, on-time) pairs that the scores put in order, ties half. Rows are counted per distinct score first;
    running counts are taken over bounded score ranges and inside a range, so no task orders all scores.
    """
    late = F.col(LABEL) == 1
    per = (scored.groupBy("late_probability").agg(count_where(late).alias("pos"), count_where(~late).alias("neg"))
           .withColumn("_range", F.floor(F.col("late_probability") * AREA_BUCKETS)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = per.groupBy("_range").agg(F.sum("neg").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy("late_probability").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_base") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    pairs = per.join(ranges, "_range").withColumn("_below", below)
    return pairs.agg(F.try_divide(F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / F.lit(2.0))),
                                  F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("roc_auc"))


def confusion(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    """Accuracy, precision and recall at the cut; precision and recall are 0 where undefined."""
    late, said = F.col(LABEL) == 1, F.col("late_probability") > cut
    counts = scored.agg(F.count("*").alias("n"), count_where(late & said).alias("tp"),
                        count_where(~late & said).alias("fp"), count_where(late & ~said).alias("fn"))

    def ratio(part: Column, whole: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)), 4)

    tp, fp, fn, n = F.col("tp"), F.col("fp"), F.col("fn"), F.col("n")
    return counts.select(ratio(n - fp - fn, n).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
                         ratio(tp, tp + fn).alias("recall"))


def evaluate(name: str, scored: DataFrame) -> DataFrame:
    """One metrics row of a model on held-out rows."""
    return confusion(scored).select(F.lit(name).alias("model"), "*",
                                    F.round(roc_auc(scored).scalar(), 4).alias("roc_auc"))


def best_model(metrics: DataFrame) -> DataFrame:
    """Name and area of the model with the highest area; ties go to the first name."""
    return metrics.agg(F.min_by("model", F.struct(-F.col("roc_auc"), F.col("model"))).alias("model"),
                       F.max("roc_auc").alias("roc_auc"))


def band_quality(scored: DataFrame, cut: float = FLAG_FROM) -> DataFrame:
    """What the flag delivers: share flagged, precision of flags, late orders caught, mean prediction, lift over the
    base rate."""
    late, flagged = F.col(LABEL) == 1, F.col("late_probability") >= cut
    counts = scored.agg(F.count("*").alias("n"), count_where(flagged).alias("flagged"), count_where(late).alias("late"),
                        count_where(flagged & late).alias("hits"), F.avg("late_probability").alias("mean_pred"))

    def pct(part: str, whole: str) -> Column:
        return F.try_divide(F.lit(100.0) * F.col(part).cast("double"), F.col(whole).cast("double"))

    precision, rate = F.coalesce(pct("hits", "flagged"), F.lit(0.0)), pct("late", "n")
    return counts.select(F.round(pct("flagged", "n"), 3).alias("flagged_pct"),
                         F.round(precision, 3).alias("flagged_precision"),
                         F.round(pct("hits", "late"), 3).alias("late_caught_pct"),
                         F.round("mean_pred", 3).alias("mean_pred"), F.round(rate, 2).alias("late_rate_pct"),
                         F.round(F.try_divide(precision, rate), 1).alias("lift"))


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    models: dict[str, PipelineModel]
    metrics: DataFrame
    bands: DataFrame
    test: DataFrame


def train(spark: SparkSession, star: Star, folder: str, forest: ForestSize = ForestSize(), seed: int = 42,
          split_by: str = "item") -> Trained:
    """The training job. The matrix is written once under ``folder`` (shared storage), so the split and the fits read a
    table instead of repeating the joins, also after a lost executor."""
    keys = ["order_id", "order_item_id"] if split_by == "item" else ["order_id"]
    matrix = with_label(with_features(training_set(star))).select("order_id", "order_item_id", *FEATURES, LABEL)
    path = f"{folder}/matrix"
    with shuffles_removed(spark):
        matrix.write.mode("overwrite").parquet(path)
    rows = split_of_stored(spark.read.parquet(path), keys, seed)
    shared_folder(spark)  # deep trees checkpoint their node ids
    fitted = fit_models(rows.filter("NOT is_test"), forest, seed)
    test = rows.filter("is_test")
    scored = {}
    for name, model in fitted.items():  # scored once, read by every evaluation
        scores(model, test).write.mode("overwrite").parquet(f"{folder}/scores/{name}")
        scored[name] = spark.read.parquet(f"{folder}/scores/{name}")
    parts = [evaluate(name, frame) for name, frame in scored.items()]
    metrics = spark.createDataFrame([r for part in parts for r in part.collect()], parts[0].schema)  # one row per model
    winner = best_model(metrics).first()["model"]
    return Trained(winner, fitted[winner], fitted, metrics, band_quality(scored[winner]), test)


def save(trained: Trained, folder: str) -> None:
    """Model, metrics, band figures and feature list under one folder."""
    spark = trained.metrics.sparkSession
    trained.model.write().overwrite().save(f"{folder}/model")
    trained.metrics.withColumn("selected", F.col("model") == trained.name).write.mode("overwrite").parquet(
        f"{folder}/metrics")
    trained.bands.write.mode("overwrite").parquet(f"{folder}/bands")
    kinds = [(c, "numeric") for c in NUMERIC] + [(c, "categorical") for c in CATEGORICAL]
    spark.createDataFrame(kinds, "feature string, kind string").write.mode("overwrite").parquet(f"{folder}/features")


def load(spark: SparkSession, folder: str) -> tuple[str, PipelineModel]:
    name = spark.read.parquet(f"{folder}/metrics").filter("selected").first()["model"]
    return name, PipelineModel.load(f"{folder}/model")
