"""Registry: name, Spark builder, and the equivalent SQL for the second engine where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources import commerce
from orderlens.sources.star import Star


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    QUERIES[name] = Query(name, build, sql)


def star_query(name: str, report: Callable[[Star], DataFrame], select: str | None = None) -> None:
    """A report on the star; ``select`` is its SQL, written against the star's common table expressions."""
    query(name, lambda spark, folder: report(commerce.star(spark, folder)), STAR_SQL + select if select else None)


# The star over the test tables, for the second engine. Written separately from the DataFrame adapter on purpose.
STAR_SQL = """
WITH base AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id, o_custkey,
         CASE WHEN o_orderkey % 10 = 0 THEN concat('P', o_custkey) ELSE concat('O', o_orderkey) END
           AS customer_unique_id,
         o_orderstatus AS order_status, o_orderdate + to_hours(cast(o_orderkey % 24 AS int)) AS purchase_ts,
         cast(strftime(o_orderdate, '%Y%m%d') AS int) AS purchase_date_key,
         10 + 4 * cast(left(o_orderpriority, 1) AS int) AS promise,
         CASE WHEN o_orderstatus <> 'P' THEN 4 * (1 + (o_orderkey * 7 + o_custkey * 3) % 40) + o_orderkey % 4 END
           AS quarters
  FROM orders),
ord AS (
  SELECT order_id, customer_id, o_custkey, customer_unique_id, order_status, purchase_ts, purchase_date_key,
         strftime(purchase_ts, '%Y-%m') AS year_month, promise,
         quarters / 4.0::double AS delivery_days, quarters IS NOT NULL AS is_delivered,
         quarters <= 4 * promise AS is_on_time,
         CASE WHEN (order_id * 31) % 20 = 0 THEN NULL
              WHEN quarters > 4 * promise THEN 1 + (order_id + o_custkey) % 3
              ELSE 3 + (order_id + o_custkey) % 3 END::int AS review_score,
         purchase_ts + to_hours(1) AS approved_ts,
         CASE WHEN quarters IS NOT NULL THEN purchase_ts + to_hours(24) END AS carrier_delivery_ts,
         purchase_ts + to_hours(cast(quarters * 6 AS int)) AS customer_delivery_ts,
         purchase_ts + to_hours(cast(promise * 24 AS int)) AS estimated_delivery_ts
  FROM base),
items AS (
  SELECT l_orderkey AS order_id,
         concat_ws('-', l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) AS bigint),
                   strftime(l_shipdate, '%Y%m%d')) AS order_item_id,
         l_partkey AS product_id, l_suppkey AS seller_id,
         cast(l_extendedprice AS decimal(12,2)) AS price, cast(l_quantity AS decimal(12,2)) AS freight_value
  FROM lineitem),
fact AS (
  SELECT i.*, o.* EXCLUDE (order_id), price + freight_value AS rev FROM items i JOIN ord o USING (order_id)),
cust AS (
  SELECT customer_id, customer_unique_id, c_mktsegment AS customer_city, n_name AS customer_state
  FROM ord JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
prod AS (
  SELECT p_partkey AS product_id, p_name AS product_category_pt,
         CASE WHEN starts_with(p_name, 'old ') THEN 'unknown' ELSE p_name END AS category,
         CASE WHEN p_partkey % 50 <> 0 THEN p_size * 100.0::double END AS product_weight_g,
         p_size::double AS length_cm, (p_size % 7 + 1)::double AS height_cm, (p_size % 11 + 1)::double AS width_cm
  FROM part),
sell AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_state FROM supplier JOIN nation ON n_nationkey = s_nationkey),
pay AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
         1 + o_orderkey % 10 AS payment_installments, cast(o_totalprice AS decimal(12,2)) AS payment_value FROM orders
  UNION ALL
  SELECT o_orderkey, 2, 'voucher', 1, cast(10 + o_orderkey % 50 AS decimal(12,2)) FROM orders
  WHERE o_orderkey % 7 = 0),
bought AS (SELECT * FROM ord SEMI JOIN items USING (order_id)),
bought_in AS (SELECT b.*, customer_state FROM bought b JOIN cust USING (customer_id)),
money AS (SELECT order_id, sum(rev) AS order_revenue FROM fact GROUP BY ALL),
person AS (
  SELECT customer_unique_id AS pid, count(*) AS n_orders, sum(order_revenue) AS revenue
  FROM money JOIN bought USING (order_id) GROUP BY ALL)
"""
