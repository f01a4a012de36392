import pytest
from pyspark.sql import functions as F

from helpers import make_star, one, rows
from orderlens.operators import quality, risk
from test_kpis import CUSTOMERS, ITEMS, ORDERS, PAYMENTS, PRODUCTS, REVIEWS


@pytest.fixture(scope="module")
def star(spark):
    return make_star(spark, ORDERS, ITEMS, customers=CUSTOMERS, products=PRODUCTS, reviews=REVIEWS, payments=PAYMENTS)


def test_null_profile(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, `c.d` string")
    assert sorted(rows(quality.null_profile(frame, "t"))) == [("t", 2, 3, "b", 2), ("t", 2, 3, "c.d", 1)]
    assert rows(quality.null_profile(frame.select("a"), "t")) == [("t", 2, 1, None, 0)]


def test_duplicates_count_rows_beyond_the_first(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert one(quality.duplicate_profile(frame, ["k"], "t"))["duplicate_rows"] == 3
    assert one(quality.duplicate_profile(frame.filter("false"), ["k"], "t"))["duplicate_rows"] == 0


def test_join_inflation_equals_the_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (2,), (9,)], "k int")
    report = one(quality.join_inflation(left, right, "k"))
    joined = left.join(right, "k", "left").count()
    assert report == {"left_rows": 4, "joined_rows": joined, "inflation": joined - 4}


def test_payment_totals_never_add_rows(star):
    orders = star.fact_orders.select("order_id").distinct()
    joined = quality.with_payment_totals(orders, star.dim_payments)
    assert joined.count() == 3
    assert {r[0]: (r[1] and float(r[1]), r[2]) for r in rows(joined)} == {
        "o1": (60.0, 2), "o2": (8.0, 2), "o3": (None, None)}


def test_suite_passes_on_a_clean_star(star):
    suite = quality.check_suite(star, dict.fromkeys(star.tables()), "2016-01-01", "2019-01-01")
    assert {r["result"] for r in quality.verdict(suite).collect()} == {"PASS"}


def test_suite_finds_every_kind_of_damage(spark, star):
    fact = star.fact_orders
    first = fact.filter("order_id = 'o2'")
    damaged = star.with_fact(
        fact.unionByName(first)  # duplicate key
        .unionByName(first.withColumns({"order_id": F.lit("x1"), "product_id": F.lit("nope")}))  # orphan product
        .unionByName(first.withColumns({"order_id": F.lit("x2"), "price": F.lit(None).cast("decimal(12,2)")}))
        .unionByName(first.withColumns({"order_id": F.lit("x3"), "delivery_days": F.lit(-1.0)}))
        .unionByName(first.withColumns({"order_id": F.lit("x4"), "delivery_days": F.lit(95.0)}))
        .unionByName(first.withColumns({"order_id": F.lit("x5"),
                                        "purchase_ts": F.lit("2031-01-01").cast("timestamp_ntz")})))
    suite = quality.check_suite(damaged, {"fact_orders": 5}, "2016-01-01", "2019-01-01", fact)
    values = {r["metric"]: r["value"] for r in suite.collect()}
    assert values["dup_fact"] == 1 and values["orphan_prod"] == 1 and values["null_price"] == 1
    assert values["negative_days"] == 1 and values["slow_over_90d_info"] == 1 and values["out_of_range"] == 1
    assert values["fact_orders"] == 11 and values["missing_or_extra"] == 6
    failed = {r["metric"] for r in suite.filter("NOT ok").collect()}
    assert failed == {"dup_fact", "orphan_prod", "null_price", "negative_days", "out_of_range", "fact_orders",
                      "missing_or_extra"}
    verdicts = dict(rows(quality.verdict(suite)))
    assert verdicts["ALL"] == "FAIL" and verdicts["row counts"] == "FAIL"


def test_forbidden_features():
    quality.forbidden_features(risk.FEATURES, risk.FORBIDDEN)
    with pytest.raises(ValueError, match="delivery_days, review_score"):
        quality.forbidden_features(["price", "review_score", "delivery_days"], risk.FORBIDDEN)


@pytest.mark.parametrize("late, imbalanced", [(0, True), (1, True), (5, False), (60, True)])
def test_class_balance(spark, late, imbalanced):
    frame = spark.range(100).selectExpr(f"CAST(id < {late} AS int) AS is_late")
    assert one(quality.class_balance(frame)) == {"n": 100, "late": late, "late_rate_pct": float(late),
                                                 "imbalanced": imbalanced}
