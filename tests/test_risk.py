from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import one, rows
from orderlens.operators import risk, service
from orderlens.sources import commerce

SIZE = risk.ForestSize(trees=8, depth=5)


@pytest.fixture(scope="module")
def trained(spark, small, tmp_path_factory):
    return risk.train(spark, commerce.star(spark, small), str(tmp_path_factory.mktemp("risk")), SIZE)


def test_features(spark):
    frame = spark.createDataFrame(
        [(datetime(2017, 3, 5, 23, 59), datetime(2017, 3, 6, 5, 59), None, "x", "y"),
         (datetime(2017, 3, 6, 0, 0), datetime(2017, 3, 6, 8, 24), "SP", None, None)],
        "purchase_ts timestamp_ntz, estimated_delivery_ts timestamp_ntz, customer_state string, "
        "product_category_en string, seller_state string")
    first, second = risk.with_features(frame).collect()
    assert (first["purchase_month"], first["purchase_hour"], first["purchase_dow"]) == (3, 23, 6)  # a Sunday
    assert first["estimated_lead_days"] == 0.2 and second["estimated_lead_days"] == 0.4  # 0.25 and 0.35, half-even
    assert first["customer_state"] == "unknown" and second["seller_state"] == "unknown"
    assert second["purchase_dow"] == 0


def test_split_is_stratified_and_stable(spark):
    frame = spark.range(1000).selectExpr("id AS order_id", "id % 3 AS order_item_id", "CAST(id % 10 = 0 AS int) AS is_late")
    keys = ["order_id", "order_item_id"]
    split = risk.stratified_split(frame, keys)
    counts = {(r[0], r[1]): r[2] for r in rows(split.groupBy("is_late", "is_test").count())}
    assert counts[(1, True)] == 20 and counts[(1, False)] == 80
    assert counts[(0, True)] == 180 and counts[(0, False)] == 720
    again = risk.stratified_split(frame.repartition(7).orderBy(F.desc("order_id")), keys)
    assert split.exceptAll(again).count() == 0
    assert split.exceptAll(risk.stratified_split(frame, keys, seed=7)).count() > 0


def test_split_by_order_keeps_orders_together(spark):
    frame = spark.range(3000).selectExpr("id % 500 AS order_id", "id AS order_item_id",
                                         "CAST(id % 500 < 50 AS int) AS is_late")
    split = risk.stratified_split(frame, ["order_id"])
    assert split.groupBy("order_id").agg(F.count_distinct("is_test").alias("n")).filter("n > 1").count() == 0


def test_models_beat_chance(trained):
    metrics = {r["model"]: r for r in trained.metrics.collect()}
    assert set(metrics) == {"logistic_regression", "random_forest"}
    assert max(m["roc_auc"] for m in metrics.values()) > 0.55
    assert metrics[trained.name]["roc_auc"] == max(m["roc_auc"] for m in metrics.values())


def test_confusion_with_no_flag_is_zero_not_null(spark):
    frame = spark.createDataFrame([(1, 0.2), (0, 0.1)], "is_late int, late_probability double")
    assert one(risk.confusion(frame)) == {"accuracy": 0.5, "precision": 0.0, "recall": 0.0}
    band = one(risk.band_quality(frame))
    assert band["flagged_pct"] == 0.0 and band["flagged_precision"] == 0.0 and band["late_caught_pct"] == 0.0


def test_area_under_curve_with_ties(spark):
    frame = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "is_late int, late_probability double")
    assert risk.roc_auc(frame).first()[0] == pytest.approx(0.875)


def test_missing_numbers_get_the_exact_median(spark):
    frame = spark.createDataFrame([(float(v), None) for v in (1, 2, 10, 100)], "a double, b double")
    assert risk.medians(frame, ["a", "b"]) == {"a": 6.0, "b": 0.0}


def test_best_model_ties_go_to_the_first_name(spark):
    frame = spark.createDataFrame([("b", 0.8), ("a", 0.8), ("c", 0.1)], "model string, roc_auc double")
    assert one(risk.best_model(frame)) == {"model": "a", "roc_auc": 0.8}


def test_saved_model_scores_alike(spark, trained, tmp_path):
    folder = str(tmp_path / "model")
    risk.save(trained, folder)
    name, model = risk.load(spark, folder)
    assert name == trained.name
    before, after = (risk.scores(m, trained.test).orderBy("order_id", "order_item_id").collect()
                     for m in (trained.model, model))
    assert before == after
    assert spark.read.parquet(f"{folder}/features").count() == len(risk.FEATURES)


def request(**changes):
    base = {"purchase_ts": datetime(1999, 5, 1, 10), "estimated_delivery_ts": datetime(1999, 5, 20),
            "customer_state": "NATION_1", "seller_state": "NATION_2", "product_category_en": "red widget",
            "price": 100.0, "freight_value": 10.0, "product_weight_g": 500.0, "length_cm": 10.0, "height_cm": 2.0,
            "width_cm": 3.0}
    return base | changes


SCHEMA = ("id int, purchase_ts timestamp_ntz, estimated_delivery_ts timestamp_ntz, customer_state string, "
          "seller_state string, product_category_en string, price double, freight_value double, "
          "product_weight_g double, length_cm double, height_cm double, width_cm double")


def test_scoring_rejects_impossible_orders(spark, trained):
    requests = [request(), request(estimated_delivery_ts=datetime(1999, 4, 1)), request(price=0.0),
                request(freight_value=-1.0), request(width_cm=-2.0), request(customer_state=None),
                request(product_weight_g=None, length_cm=None), request(customer_state="ATLANTIS"),
                request(estimated_delivery_ts=datetime(1999, 5, 1, 10), freight_value=0.0)]
    frame = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(requests)], SCHEMA)
    scored, rejected = service.score_orders(frame, trained.model, trained.name)
    done = {r["id"]: r for r in scored.collect()}
    reasons = {r["id"]: r["reject_reason"] for r in rejected.collect()}
    assert set(done) == {0, 6, 7, 8}  # missing sizes and unseen states are fine
    assert reasons == {1: "estimated_delivery_ts must be on or after purchase_ts", 2: "price must be positive",
                       3: "freight_value must not be negative", 4: "width_cm must not be negative",
                       5: "customer_state is missing"}
    assert all(0 <= r["late_probability"] <= 1 and r["model"] == trained.name for r in done.values())


def test_requests_without_sizes(spark, trained):
    """Optional fields may be missing altogether; they are imputed like missing values."""
    frame = trained.test.limit(3).select("order_id", "customer_state", "seller_state", "product_category_en", "price",
                                         "freight_value").withColumns(
        {"purchase_ts": F.lit("2017-01-01").cast("timestamp_ntz"), "estimated_delivery_ts": F.lit("2017-02-01").cast(
            "timestamp_ntz"), "price": F.lit(5.0), "freight_value": F.lit(1.0)})
    scored, rejected = service.score_orders(frame, trained.model, trained.name)
    assert scored.columns == [*frame.columns, "late_probability", "risk_band", "model"]
    assert scored.count() == 3 and rejected.count() == 0


def test_unseen_category_is_all_zeros(trained):
    stages = trained.model.stages[:-1]
    row = trained.test.limit(1).withColumns({c: F.lit("never seen") for c in risk.CATEGORICAL})
    for stage in stages:
        row = stage.transform(row)
    for column in risk.CATEGORICAL:
        assert row.first()[f"{column}_v"].numNonzeros() == 0


@pytest.mark.parametrize("p, band", [(0.0, "Low"), (0.2999, "Low"), (0.3, "Medium"), (0.6, "Medium"), (0.6001, "High")])
def test_bands(spark, p, band):
    assert spark.createDataFrame([(p,)], "p double").select(service.risk_band(F.col("p"))).first()[0] == band


def test_models_of_the_named_queries_are_fitted_on_all_training_rows(spark, small, monkeypatch):
    """Failed before: beyond 10,000 rows a draw of them was used."""
    from dataclasses import replace

    from orderlens.plans import risk as plans

    matrix = risk.with_label(risk.with_features(risk.training_set(commerce.star(spark, small))))
    rows_ = matrix.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(4)]))).withColumn(
        "order_item_id", F.concat_ws("/", "order_item_id", "copy")).drop("copy")
    seen = []
    for learner in (risk.LogisticRegression, risk.RandomForestClassifier):
        def fit(self, data, params=None, own=learner.fit):
            seen.append(data.count())
            return own(self, data)
        monkeypatch.setattr(learner, "fit", fit)
    risk.fit_models(rows_, replace(plans.FOREST, trees=1, depth=1))
    assert seen == [rows_.count()] * 2 and seen[0] > 10_000


def test_cuts_come_from_the_stored_table(spark, small, monkeypatch):
    """Failed before: the star was joined again for the cuts of the split."""
    from orderlens.plans import all_queries

    frame = spark.range(1000).selectExpr("id AS order_id", "id % 3 AS order_item_id", "CAST(id % 10 = 0 AS int) AS is_late")
    keys = ["order_id", "order_item_id"]
    assert risk.split_of_stored(frame, keys).exceptAll(risk.stratified_split(frame, keys)).count() == 0
    late = frame.filter("is_late = 1")
    assert risk.split_of_stored(late, keys).exceptAll(risk.stratified_split(late, keys)).count() == 0
    read, own = [], risk.stratified_cuts

    def cuts(rows_, *args, **kwargs):
        read.extend(rows_.inputFiles())
        return own(rows_, *args, **kwargs)
    monkeypatch.setattr(risk, "stratified_cuts", cuts)
    all_queries()["risk_logistic_mean"].build(spark, small)
    assert read and not any("lineitem" in path for path in read)


def test_the_forest_queries_join_the_items_once(spark, small, monkeypatch):
    """Failed before: once for the matrix, once more for the cuts and twice for the requests."""
    from orderlens.plans import all_queries

    made, read, own, cuts = [], [], risk.training_set, risk.stratified_cuts
    monkeypatch.setattr(risk, "training_set", lambda star: made.append(1) or own(star))
    monkeypatch.setattr(risk, "stratified_cuts", lambda rows_, *a, **k: read.extend(rows_.inputFiles()) or cuts(rows_, *a, **k))
    served = all_queries()["service_forest_scoring"].build(spark, small)
    assert made == [1] and read and not any("lineitem" in path for path in [*read, *served.inputFiles()])
