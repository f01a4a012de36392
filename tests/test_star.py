from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import make_star, one, raw_tables, rows
from orderlens.operators import star as build
from orderlens.sources import commerce

ORDERS = [
    ("o1", "c1", "delivered", "2017-03-01 10:00:00", "2017-03-04 10:00:00", "2017-03-10 00:00:00"),
    ("o2", "c2", "delivered", "2017-03-02 00:00:00", "2017-03-05 04:48:00", "2017-03-05 04:48:00"),
    ("o3", "c3", "shipped", "2017-04-02 00:00:00", None, "2017-04-12 00:00:00"),
    ("o4", "c4", "delivered", "2017-04-03 00:00:00", "2017-05-03 00:00:00", "2017-04-12 00:00:00"),
    ("o5", "c5", "delivered", "garbage", "2017-05-03 00:00:00", None),
]
ITEMS = [("o1", 1, "p1", 10, 1), ("o1", 2, "p2", 20, 2), ("o2", 1, "p1", 5.5, 0), ("o3", 1, "p3", 7, 1),
         ("o4", 1, "p3", 8, 1), ("o5", 1, "p1", 1, 1), ("orphan", 1, "p1", 99, 1)]
REVIEWS = [
    ("r1", "o1", 5, "2017-03-06 00:00:00", "2017-03-07 00:00:00"),
    ("r1", "o1", 2, "2017-03-06 00:00:00", None),
    ("r2", "o2", 5, "2017-01-01 00:00:00", "2017-01-02 00:00:00"),
    ("r3", "o2", 1, "2017-01-09 00:00:00", "2017-01-10 00:00:00"),
    ("r4", "o4", 3, None, "2017-01-01 00:00:00"),
    ("r5", "o4", 4, "2017-06-01 00:00:00", "2017-06-02 00:00:00"),
]


@pytest.fixture(scope="module")
def star(spark):
    return make_star(spark, ORDERS, ITEMS, reviews=REVIEWS, products=[("p1", None), ("p2", "x"), ("p3", "y")],
                     translation=[("y", "WHY")], customers=[(f"c{i}", f"u{i}", f"  S{i}\t") for i in range(1, 6)])


def test_fact_has_one_row_per_item_and_drops_orphans(star):
    assert star.fact_orders.count() == 6
    assert len(star.fact_orders.columns) == 18


def test_delivery_arithmetic(star):
    facts = {r["order_id"]: r for r in star.fact_orders.collect()}
    assert facts["o1"]["delivery_days"] == 3.0 and facts["o1"]["is_on_time"] is True
    assert facts["o2"]["delivery_days"] == 3.2 and facts["o2"]["is_on_time"] is True  # exactly at the promise
    assert facts["o3"]["delivery_days"] is None and facts["o3"]["is_on_time"] is None
    assert facts["o3"]["is_delivered"] is False
    assert facts["o4"]["is_on_time"] is False
    # unreadable purchase time; delivered without a promise counts as late
    assert facts["o5"]["purchase_ts"] is None and facts["o5"]["delivery_days"] is None
    assert facts["o5"]["is_delivered"] is True and facts["o5"]["is_on_time"] is False
    assert facts["o1"]["purchase_date_key"] == 20170301 and facts["o5"]["purchase_date_key"] is None


def test_missing_answer_time_wins(star):
    reviews = {r["review_id"]: r for r in star.dim_reviews.collect()}
    assert len(reviews) == 5 and reviews["r1"]["review_score"] == 2


def test_first_review_of_an_order(star):
    scores = dict(rows(star.fact_orders.select("order_id", "review_score").distinct()))
    assert scores == {"o1": 2, "o2": 5, "o3": None, "o4": 4, "o5": None}  # undated reviews come last


def test_category_translation(star):
    names = {r["product_id"]: (r["product_category_pt"], r["product_category_en"]) for r in star.dim_products.collect()}
    assert names == {"p1": ("unknown", "unknown"), "p2": ("x", "unknown"), "p3": ("y", "WHY")}


def test_states_are_stripped(star):
    assert {r["customer_state"] for r in star.dim_customers.collect()} == {f"S{i}" for i in range(1, 6)}
    assert [r["seller_state"] for r in star.dim_sellers.collect()] == ["SP"]


def test_lenient_timestamp(spark):
    frame = spark.createDataFrame([("2017-01-02 03:04:05",), ("2017-01-02",), ("garbage",), (None,), ("",)], "t string")
    assert [r[0] for r in frame.select(build.lenient_timestamp(F.col("t"))).collect()] == [
        datetime(2017, 1, 2, 3, 4, 5), datetime(2017, 1, 2), None, None, None]


def test_calendar(spark):
    days = build.calendar(spark, "2016-01-01", "2020-12-31")
    assert days.count() == 1827
    assert one(days.filter("date_key = 20171001")) == {
        "date_key": 20171001, "full_date": date(2017, 10, 1), "year": 2017, "month": 10, "month_name": "October",
        "quarter": 4, "day_of_week": 7, "day_name": "Sunday", "is_weekend": True, "year_month": "2017-10"}


def test_repeated_reviews_do_not_add_rows(spark):
    many = REVIEWS + [(f"x{i}", "o1", 1, "2017-08-01 00:00:00", "2017-08-02 00:00:00") for i in range(50)]
    raw = raw_tables(spark, ORDERS, ITEMS, reviews=many)
    assert build.build_star(spark, raw).fact_orders.count() == 6


def test_raw_build_equals_direct_adapter(spark, small):
    """Both ways to the star give the same facts apart from what the raw data deliberately damages."""
    direct = commerce.star(spark, small).fact_orders
    built = build.build_star(spark, commerce.raw_frames(spark, small), *commerce.calendar_days(spark, small)).fact_orders
    columns = [c for c in direct.columns if c not in ("approved_ts", "review_score")]
    assert direct.select(columns).exceptAll(built.select(columns)).count() == 0
    assert built.select(columns).exceptAll(direct.select(columns)).count() == 0
