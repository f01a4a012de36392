import pytest

from helpers import make_star, rows
from orderlens.operators import explore, kpis, shared
from orderlens.sources import commerce
from orderlens.sources.star import read_star, write_star
from test_kpis import CUSTOMERS, ITEMS, ORDERS, PAYMENTS, PRODUCTS, REVIEWS


def same(star, **limits):
    once = shared.share_scan(star)
    for got, wanted in ((shared.kpi_reports(once), kpis.reports(star)),
                        (shared.explore_reports(once, **limits), explore.reports(star, **limits))):
        assert list(got) == list(wanted)
        for name, report in wanted.items():
            assert got[name].columns == report.columns, name
            assert rows(got[name]) == rows(report), name


def test_all_reports_equal_their_own_scans(spark, small):
    same(commerce.star(spark, small))
    same(commerce.star(spark, small), min_orders=3, n=4)


def test_small_odd_star(spark):
    """Undelivered orders, buyers without reviews, an order outside the calendar and one of an unknown buyer."""
    orders = [*ORDERS, ("o8", "c8", "shipped", "2031-01-01 10:00:00", None, "2031-01-20 00:00:00"),
              ("o9", "c9", "delivered", "2017-03-05 10:00:00", "2017-03-09 10:00:00", None)]
    items = [*ITEMS, ("o8", 1, "p1", 5, 1), ("o9", 1, "p1", 7, 1), ("o9", 2, "p1", 7, 1)]
    made = make_star(spark, orders, items, customers=[*CUSTOMERS, ("c8", "u8", None)], products=PRODUCTS, reviews=REVIEWS,
                     payments=PAYMENTS)
    same(made, min_orders=1, n=1)
    same(made.with_fact(made.fact_orders.filter("false")), min_orders=1)


def test_the_fact_is_read_once(spark, small, tmp_path):
    write_star(commerce.star(spark, small), str(tmp_path / "kept"))
    star = read_star(spark, str(tmp_path / "kept"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")

    def reads(frame):
        plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
        return sum("kept/fact_orders" in line for line in plan.split("\n") if line.startswith("Location:"))

    once = shared.share_scan(star)
    assert reads(shared.order_products(star)) == 1
    made = {**shared.kpi_reports(once), **shared.explore_reports(once)}
    assert sum(map(reads, made.values())) == 0 and reads(explore.findings(shared.explore_reports(once))) == 0
    assert reads(explore.findings(explore.reports(star))) > 8
    plan = shared.counted(once.orders)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange hashpartitioning") == 1
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", ["all", "month", "state", "outcome", "bucket"])
def test_sets_count_every_order(spark, small, name):
    once = shared.share_scan(commerce.star(spark, small))
    total = once.cube.filter(f"grouped = '{name}'").groupBy().sum("orders").first()[0]
    assert total == once.orders.count()
