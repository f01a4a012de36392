from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import make_star, one, rows
from orderlens.operators import report
from test_kpis import CUSTOMERS, ITEMS, ORDERS, PRODUCTS, REVIEWS


@pytest.fixture(scope="module")
def view(spark):
    star = make_star(spark, ORDERS, ITEMS, customers=CUSTOMERS, products=PRODUCTS, reviews=REVIEWS)
    return report.item_view(star)


def select(view, **kwargs):
    return report.filtered_items(view, report.Filters(**kwargs))


def test_filters_are_inclusive(view):
    assert select(view, date_from=date(2017, 3, 2), date_to=date(2017, 4, 2)).count() == 2
    assert select(view, states=("SP",)).count() == 4
    assert select(view, categories=("B",)).count() == 2
    assert select(view, states=()).count() == 0


def test_rows_without_state_or_category_drop_out(view):
    damaged = view.withColumn("category", F.when(F.col("order_id") != "o3", F.col("category")))
    assert select(damaged).count() == 4


def test_first_item_is_taken_after_filtering(view):
    def category_of(items):
        return {r["order_id"]: r["category"] for r in report.orders_view(items).collect()}

    assert category_of(select(view))["o1"] == "A"
    assert category_of(select(view, categories=("B",)))["o1"] == "B"


def test_cards(view):
    assert one(report.kpi_cards(select(view))) == {"revenue": 80.0, "on_time_pct": 50.0, "avg_score": 2.33,
                                                   "repeat_rate": 50.0}


def test_empty_selection_gives_nulls_and_no_error(view):
    nothing = select(view, date_from=date(2030, 1, 1))
    assert one(report.kpi_cards(nothing)) == {"revenue": 0.0, "on_time_pct": None, "avg_score": None,
                                              "repeat_rate": None}
    for dataset in (report.monthly_revenue, report.top_states, report.delivery_days_by_state, report.on_time_by_month,
                    report.late_by_category, report.score_distribution, report.scores_by_punctuality,
                    report.worst_reviewed_categories, report.buyer_types, report.orders_per_customer):
        assert dataset(nothing).count() == 0
    assert [r[2] for r in rows(report.buyer_shares(nothing))] == [None] * 4


def test_missing_buyer_type_shows_zero(view):
    shares = {(r[0], r[1]): r[2] for r in rows(report.buyer_shares(select(view, states=("RJ",))))}
    assert shares == {("One-time", "% of customers"): 100.0, ("One-time", "% of revenue"): 100.0,
                      ("Repeat (2+ orders)", "% of customers"): 0.0, ("Repeat (2+ orders)", "% of revenue"): 0.0}


def test_histogram_is_capped(spark):
    orders = [(f"o{i}", f"c{i}", "delivered", "2017-03-01 00:00:00", None, None) for i in range(10)]
    buyers = [(f"c{i}", "many" if i < 7 else f"u{i}", "SP") for i in range(10)]
    items = [(f"o{i}", 1, "p", 1, 0) for i in range(10)]
    view = report.item_view(make_star(spark, orders, items, customers=buyers))
    assert rows(report.orders_per_customer(report.filtered_items(view))) == [("1", 3), ("5+", 1)]
    kinds = {r["order_id"]: (r["n_orders_per_cust"], r["buyer_type"])
             for r in report.buyer_types(report.filtered_items(view)).collect()}
    assert kinds["o0"] == (7, "Repeat (2+ orders)") and kinds["o9"] == (1, "One-time") and len(kinds) == 10


def test_domains(view):
    assert rows(report.filter_domains(view)) == [
        ("category", "A"), ("category", "B"), ("date_max", "2017-04-02"), ("date_min", "2017-03-01"),
        ("state", "RJ"), ("state", "SP")]
