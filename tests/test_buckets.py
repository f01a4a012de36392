import re

import pytest

from helpers import rows
from orderlens.operators import kpis, service
from orderlens.session import scratch_path
from orderlens.sources import buckets, commerce


@pytest.fixture(scope="module")
def folder(spark, small):
    path = scratch_path(spark, "bucketed")
    buckets.write_bucketed_star(commerce.star(spark, small), path, 8)
    return path


def item_shuffles(frame):
    """Exchanges by order id: those that move items to bring the rows of an order together."""
    plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    return len(re.findall(r"Exchange hashpartitioning\(order_id", plan))


@pytest.mark.parametrize("report", [service.headline_kpis, kpis.delivery_days_by_month, kpis.on_time_rate, kpis.review_scores,
                                    kpis.revenue_by_month, kpis.repeat_rate])
def test_order_grain_without_a_shuffle_of_items(spark, small, folder, report):
    plain, bucketed = commerce.star(spark, small), buckets.open_bucketed_star(spark, folder)
    assert rows(report(bucketed)) == rows(report(plain))
    assert item_shuffles(report(bucketed)) == 0 < item_shuffles(report(plain))


def test_opened_by_another_session(spark, folder):
    before = buckets.open_bucketed_star(spark, folder).fact_orders
    wanted = sorted(map(str, rows(before.select("order_id", "order_item_id", "price"))))
    spark.sql(f"DROP TABLE {buckets._table(folder)}")  # as if this session had never seen it; the files stay
    again = buckets.open_bucketed_star(spark, folder)
    assert sorted(map(str, rows(again.fact_orders.select("order_id", "order_item_id", "price")))) == wanted
    assert item_shuffles(service.headline_kpis(again)) == 0
