"""The three grains of the star: item (fact row), order, person.

Order-level columns (customer, dates, delivery, review) are copied to every item row of an order when the fact is built,
so they are constant within an order. Collapsing is always an aggregation with map-side combine, never a window over an
order's rows: an order with very many items does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.measures import item_revenue


def order_grain(fact: DataFrame, *columns: str) -> DataFrame:
    """One row per order with the given order-level columns."""
    return fact.select("order_id", *columns).distinct()


def order_money(fact: DataFrame, *columns: str) -> DataFrame:
    """One row per order with its revenue, so that later joins see orders instead of items."""
    return fact.groupBy("order_id", *columns).agg(F.sum(item_revenue()).alias("order_revenue"))


def first_item(items: DataFrame, order_columns: list[str], item_columns: list[str]) -> DataFrame:
    """One row per order: order-level columns plus those of its lowest ``order_item_id`` among the given items."""
    pick = F.min(F.struct("order_item_id", *item_columns)).alias("_first")
    return (items.groupBy("order_id", *order_columns).agg(pick)
            .select("order_id", *order_columns, *[F.col(f"_first.{c}").alias(c) for c in item_columns]))


def person_orders(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders and revenue of every person with at least one fact row.

    Orders carry a new ``customer_id`` each time; the person is ``customer_unique_id``.
    """
    ids = customers.select("customer_id", "customer_unique_id")
    return (order_money(fact, "customer_id").join(ids, "customer_id")
            .groupBy("customer_unique_id")
            .agg(F.count("*").alias("n_orders"), F.sum("order_revenue").alias("revenue")))
