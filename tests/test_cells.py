from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import rows
from orderlens.operators import cells, report
from orderlens.session import scratch_path
from orderlens.sources import commerce
from orderlens.sources.star import Star

FILTERS = {
    "all": report.Filters(),
    "dates": report.Filters(date(1994, 2, 14), date(1996, 7, 3)),
    "everything": report.Filters(date(1993, 1, 2), date(1998, 6, 30), tuple(f"NATION_{i}" for i in range(0, 25, 2)),
                                 ("small widget", "red widget", "cold widget", "unknown", "blue anvil")),
    "categories": report.Filters(categories=("small ring", "unknown")),
    "nothing": report.Filters(date(2031, 1, 1)),
}
SMALL = {"delivery_days_by_state": {"min_orders": 2}, "worst_reviewed_categories": {"min_orders": 2}}


@pytest.fixture(scope="module")
def view(spark, small):
    path = scratch_path(spark, "view")
    report.item_view(commerce.star(spark, small)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def stored(spark, view):
    folder = scratch_path(spark, "cells")
    cells.write_cells(cells.build_cells(view), folder)
    return folder


@pytest.mark.parametrize("name", list(FILTERS))
def test_all_charts_equal_those_from_items(spark, view, stored, name):
    items = report.filtered_items(view, FILTERS[name])
    picked = cells.selected(cells.read_cells(spark, stored), FILTERS[name])
    for chart, function in cells.CHARTS.items():
        if chart == "filter_domains":
            wanted = report.filter_domains(items)
        else:
            wanted = getattr(report, chart)(items, **SMALL.get(chart, {}))
        got = function(picked, **SMALL.get(chart, {}))
        assert got.columns == wanted.columns, chart
        assert rows(got) == rows(wanted), chart


def test_reads_cells_of_the_months_only(spark, stored):
    picked = cells.selected(cells.read_cells(spark, stored), FILTERS["dates"])
    plan = cells.kpi_cards(picked)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "order_item_id" not in plan


def test_orders_of_several_categories_and_odd_buyers(spark):
    """An order counts once under any filter; its category is that of its first passing item; buyers may be unknown."""
    schema = ("order_id int, order_item_id int, purchase_ts timestamp_ntz, item_revenue decimal(12,2), delivery_days double, "
              "is_delivered boolean, is_on_time boolean, review_score int, customer_state string, customer_unique_id string, "
              "category string, month string")
    data = [(1, 1, "b", "p"), (1, 2, "a", "p"), (2, 1, "a", "p"), (3, 1, "a", None), (4, 1, None, "q"), (5, 1, "c", "q"),
            (6, 2, "a", "r"), (6, 1, "c", "r"), (6, 3, "a", "r")]
    view = spark.createDataFrame([(o, i, None, 1.5, float(o), o % 2 == 0, None if o == 2 else o > 3, o if o < 6 else None,
                                   "S", p, c, "2020-01") for o, i, c, p in data],
                                 schema.replace("decimal(12,2)", "double").replace("timestamp_ntz", "string")).withColumns(
        {"purchase_ts": F.lit("2020-01-05 10:00:00").cast("timestamp_ntz"),
         "item_revenue": F.col("item_revenue").cast("decimal(12,2)")})
    made = cells.build_cells(view)
    for filters in (report.Filters(), report.Filters(categories=("a",)), report.Filters(categories=("c", "b"))):
        items, picked = report.filtered_items(view, filters), cells.selected(made, filters)
        for chart, function in cells.CHARTS.items():
            if chart != "filter_domains":
                more = {"min_orders": 1} if chart in SMALL else {}
                assert rows(function(picked, **more)) == rows(getattr(report, chart)(items, **more)), (chart, filters)


def test_cells_of_later_months_are_added(spark, view, stored):
    folder = scratch_path(spark, "cells")
    early, late = view.filter("month < '1995'"), view.filter("month >= '1995'")
    several = cells.build_cells(view)  # who buys again is known from all orders
    for part in (early, late):
        months = [r["month"] for r in part.select("month").distinct().collect()]
        cells.write_cells(cells.Cells(*(getattr(several, t).filter(F.col("month").isin(months)) for t in cells.TABLES)), folder)
    both, whole = (cells.selected(cells.read_cells(spark, f)) for f in (folder, stored))
    assert rows(cells.kpi_cards(both)) == rows(cells.kpi_cards(whole))


def test_buyers_kinds_are_joined_once_for_all_tables(view):
    built = cells.build_cells(view)
    for name in cells.TABLES:
        assert "Join" not in getattr(built, name)._jdf.queryExecution().optimizedPlan().toString()


def test_star_cells_are_those_of_its_view(spark, small):
    """Also where customers and products are there twice, in two states or without one, or the person is unknown."""
    plain = commerce.star(spark, small)
    buyers, products = plain.dim_customers, plain.dim_products
    again = buyers.filter("customer_id % 5 = 0").withColumn("customer_state", F.expr(
        "CASE customer_id % 3 WHEN 0 THEN customer_state WHEN 1 THEN 'elsewhere' END")).withColumn(
        "customer_unique_id", F.expr("if(customer_id % 2 = 0, customer_unique_id, NULL)"))
    odd = Star({n: (lambda n=n: getattr(plain, n)) for n in Star.NAMES} | {
        "dim_customers": lambda: buyers.unionByName(again).unionByName(again),
        "dim_products": lambda: products.unionByName(products.filter("product_id % 7 = 0")).withColumn(
            "product_category_en", F.expr("if(product_id % 11 = 0, NULL, product_category_en)"))})
    for star in (plain, odd):
        got, wanted = cells.build_star_cells(star), cells.build_cells(report.item_view(star))
        for name in cells.TABLES:
            columns = sorted(getattr(wanted, name).columns)
            assert sorted(getattr(got, name).columns) == columns
            assert sorted(map(repr, rows(getattr(got, name).select(columns)))) == sorted(
                map(repr, rows(getattr(wanted, name).select(columns)))), name
