from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import make_star, one, rows
from orderlens.operators import evidence, explore, kpis, service
from orderlens.sources import commerce

ORDERS = [
    ("o1", "c1", "delivered", "2017-03-01 00:00:00", "2017-03-04 00:00:00", "2017-03-10 00:00:00"),
    ("o2", "c2", "delivered", "2017-03-02 00:00:00", "2017-03-12 00:00:00", "2017-03-10 00:00:00"),
    ("o3", "c3", "shipped", "2017-04-02 00:00:00", None, "2017-04-12 00:00:00"),
]
# o1: three items in two categories
ITEMS = [("o1", 1, "pa", 10, 1), ("o1", 2, "pa2", 20, 2), ("o1", 3, "pb", 30, 3), ("o2", 1, "pb", 5, 1),
         ("o3", 1, "pa", 7.25, 0.75)]
PRODUCTS = [("pa", "a"), ("pa2", "a"), ("pb", "b")]
CUSTOMERS = [("c1", "u1", "SP"), ("c2", "u1", "RJ"), ("c3", "u2", "SP")]
REVIEWS = [("r1", "o1", 5, "2017-03-05 00:00:00", "2017-03-06 00:00:00"),
           ("r2", "o2", 1, "2017-03-15 00:00:00", "2017-03-16 00:00:00"),
           ("r3", "o3", 1, "2017-05-01 00:00:00", "2017-05-02 00:00:00")]
PAYMENTS = [("o1", 1, "card", 3, 50), ("o1", 2, "voucher", 1, 10), ("o2", 1, "card", 1, 6), ("o2", 2, "card", 1, 2)]


@pytest.fixture(scope="module")
def star(spark):
    return make_star(spark, ORDERS, ITEMS, customers=CUSTOMERS, products=PRODUCTS, reviews=REVIEWS, payments=PAYMENTS)


def test_grain(star):
    assert one(kpis.on_time_rate(star)) == {"delivered_orders": 2, "on_time_orders": 1, "on_time_pct": 50.0,
                                            "late_orders": 1}
    assert rows(kpis.revenue_by_month(star)) == [("2017-03", 2, 72.0), ("2017-04", 1, 8.0)]
    assert rows(kpis.revenue_by_category(star)) == [("A", 2, 41.0), ("B", 2, 39.0)]
    # (order, product) pairs: the two products of category a count twice
    assert {r[0]: r[1] for r in rows(kpis.worst_categories(star, 1))} == {"A": 2, "B": 2}


def test_persons_not_customer_ids(star):
    assert one(kpis.repeat_rate(star)) == {"total_customers": 2, "repeat_customers": 1, "repeat_rate_pct": 50.0,
                                           "avg_orders_per_customer": 1.5}
    split = {r[0]: r[1:] for r in rows(kpis.repeat_vs_one_time_revenue(star))}
    assert split == {"repeat_customer": (2, 72.0, 90.0), "one_time_customer": (1, 8.0, 10.0)}


def test_payment_types(star):
    table = {r[0]: r[1:] for r in rows(kpis.payment_types(star))}
    assert table["card"] == (2, 3, 58.0, 85.3, 1.7) and table["voucher"] == (1, 1, 10.0, 14.7, 1.0)


def test_review_scores_and_denominators(star):
    assert one(kpis.review_scores(star))["score_1"] == 2
    shares = one(explore.one_star_shares(star))
    assert shares["late_pct_of_all"] == 50.0 and shares["late_pct_of_delivered"] == 100.0


def test_headline(star):
    assert one(service.headline_kpis(star)) == {"total_revenue_brl": 80.0, "on_time_pct": 50.0,
                                                "avg_review_score": 2.33, "repeat_purchase_rate_pct": 50.0}


def test_headline_keeps_orders_without_a_known_buyer(spark):
    star = make_star(spark, ORDERS, ITEMS, customers=CUSTOMERS[:2], products=PRODUCTS)
    assert one(service.headline_kpis(star))["total_revenue_brl"] == 80.0
    assert one(service.headline_kpis(star))["repeat_purchase_rate_pct"] == 100.0


def test_states_without_deliveries_come_last(star):
    table = rows(service.kpis_by_state(star))
    assert table == [("RJ", 1, 0.0, 10.0), ("SP", 1, 100.0, 3.0)]
    empty = star.with_fact(star.fact_orders.filter("order_id = 'o3'"))
    assert rows(service.kpis_by_state(empty)) == [("SP", 0, None, None)]


def test_empty_fact(star):
    empty = star.with_fact(star.fact_orders.filter("false"))
    assert one(service.headline_kpis(empty)) == {"total_revenue_brl": 0.0, "on_time_pct": None,
                                                 "avg_review_score": None, "repeat_purchase_rate_pct": None}
    assert one(kpis.on_time_rate(empty))["on_time_pct"] is None
    assert kpis.top_categories(empty).count() == 0
    assert kpis.delivery_days_by_month(empty).count() == 0


@pytest.mark.parametrize("days, bucket", [(3.0, "1"), (3.2, "2"), (7.0, "2"), (60.0, "5"), (60.1, "6"), (14.01, "4")])
def test_buckets(spark, days, bucket):
    frame = spark.createDataFrame([(days,)], "d double")
    assert frame.select(kpis.delivery_bucket(F.col("d"))).first()[0].startswith(bucket)


def test_ties_are_ordered_by_category(spark):
    items = [("o1", 1, "z", 10, 0), ("o2", 1, "m", 10, 0), ("o3", 1, "a", 10, 0)]
    star = make_star(spark, ORDERS, items)
    assert [r[0] for r in rows(kpis.top_categories(star, 2))] == ["C_A", "C_M"]
    assert [(r[0], r[1], r[2]) for r in rows(explore.category_extremes(star, 2))] == [
        ("top2", 1, "C_A"), ("top2", 2, "C_M"), ("bottom2", 3, "C_Z")]


def test_order_reports_do_not_change_when_items_are_duplicated(spark, small):
    """More items per order, same orders: order-level reports must not move."""
    star = commerce.star(spark, small)
    copies = star.fact_orders.withColumn("order_item_id", F.concat("order_item_id", F.lit("-copy")))
    doubled = star.with_fact(star.fact_orders.unionByName(copies))
    for report in (kpis.on_time_rate, kpis.delivery_days_by_month, kpis.review_scores, kpis.repeat_rate,
                   kpis.reviews_by_punctuality, kpis.delivery_distribution, kpis.monthly_experience,
                   lambda s: kpis.worst_states(s, 1), service.kpis_by_state, explore.one_star_shares):
        assert rows(report(doubled)) == rows(report(star))
    assert one(kpis.revenue_by_month(doubled).agg(F.sum("revenue_brl").alias("r")))["r"] == pytest.approx(
        2 * one(kpis.revenue_by_month(star).agg(F.sum("revenue_brl").alias("r")))["r"])


def test_shares_sum_to_100(spark, small):
    star = commerce.star(spark, small)
    for report, column in ((kpis.revenue_by_state, "pct_of_total"), (kpis.delivery_distribution, "pct_of_delivered"),
                           (kpis.payment_types, "pct_of_value"), (explore.review_distribution, "pct")):
        frame = report(star)
        total, n = frame.agg(F.sum(column), F.count("*")).first()
        assert abs(total - 100) <= 0.05 * n


def test_items_weigh_in_the_state_evidence(star):
    table = {r[0]: r[1:] for r in rows(evidence.states_worst_first(star, 1))}
    assert table == {"SP": (1, 100.0, 3.0), "RJ": (1, 0.0, 10.0)}
    head = one(evidence.headline_items(star))
    assert head["ontime_pct_delivered"] == 75.0 and head["avg_delivery_days"] == 4.8


def test_published_excess_late_orders(spark):
    """Published figures: six states against 91.89%, 492 late orders too many."""
    states = spark.createDataFrame(
        [("AL", 397, 76.1), ("MA", 717, 80.3), ("PI", 476, 84.0), ("CE", 1279, 84.7), ("SE", 335, 84.8),
         ("BA", 3256, 86.0), ("SP", 40494, 94.1)], "customer_state string, delivered_orders bigint, on_time_pct double")
    overall = spark.createDataFrame([(91.89,)], "on_time_pct double")
    table = {r[0]: r[3] for r in rows(explore.excess_late_orders(states, overall))}
    assert table == {"AL": 63, "MA": 83, "PI": 38, "CE": 92, "SE": 24, "BA": 192, "Total": 492}
    only = explore.excess_late_orders(states, overall, ["AL", "SP"])
    assert {r[0]: r[3] for r in rows(only)} == {"AL": 63, "Total": 63}


def test_money_is_exact(spark):
    items = [("o1", n, "p", "0.10", "0.20") for n in range(1, 1001)]
    star = make_star(spark, ORDERS, items)
    assert star.fact_orders.agg(F.sum(F.col("price") + F.col("freight_value"))).first()[0] == Decimal("300.00")
    assert rows(kpis.revenue_by_month(star)) == [("2017-03", 1, 300.0)]


def test_evidence_block_shows_ten_rows_and_says_when_there_are_more(spark):
    report = spark.range(12).selectExpr("id AS k", "id % 2 = 0 AS even", "CAST(NULL AS double) AS gap",
                                        "CAST(id AS double) * 1e7 AS big").orderBy("k")
    block = one(evidence.evidence_block(report, "numbers", {"big": 2}))
    lines = block["content"].split("\n")
    assert lines[0] == "Result of query 'numbers':" and len(lines) == 11 and block["truncated"] is True
    assert lines[2] == "  k=1, even=False, gap=None, big=10000000.00"
    empty = one(evidence.evidence_block(report.filter("false"), "numbers"))
    assert empty["content"] == "numbers: no rows returned" and empty["truncated"] is False


def test_evidence_packs_number_reports_before_passages(spark):
    asked = spark.createDataFrame([("q1", "mixed", ["b", "a"]), ("q2", "document", ["a"]), ("q3", "numeric", ["a"])],
                                  "question_id string, route string, intents array<string>")
    blocks = spark.createDataFrame([("a", 0, "SQL: a", "one", False), ("b", 0, "SQL: b", "two", False),
                                    ("b", 1, "SQL: b2", "three", False)],
                                   "intent string, part int, label string, content string, truncated boolean")
    passages = spark.createDataFrame([("q1", 1, "Doc", "text"), ("q2", 2, "Late", "x"), ("q2", 1, "Early", "y"),
                                      ("q3", 1, "Doc", "never")],
                                     "question_id string, rank int, label string, content string")
    packs = {r["question_id"]: r["pack"] for r in evidence.evidence_packs(asked, blocks, passages).collect()}
    assert packs["q1"] == "[E1] SQL: b\ntwo\n\n[E2] SQL: b2\nthree\n\n[E3] SQL: a\none\n\n[E4] DOC: Doc\ntext"
    assert packs["q2"] == "[E1] DOC: Early\ny\n\n[E2] DOC: Late\nx"
    assert packs["q3"] == "[E1] SQL: a\none"
