"""Profiles, checks, and the raw-to-star build."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import quality, risk, star as build
from orderlens.plans.registry import STAR_SQL, query, star_query
from orderlens.schemas import STAR_KEYS
from orderlens.sources import commerce
from orderlens.sources.star import Star

# ---------------------------------------------------------------- profiles

RAW_REVIEWS = """
, rv AS (
  SELECT order_id AS review_id, order_id, review_score, purchase_ts + INTERVAL 20 DAY AS created,
         if(order_id % 33 = 0, NULL, purchase_ts + INTERVAL 22 DAY) AS answered
  FROM ord WHERE review_score IS NOT NULL
  UNION ALL SELECT order_id, order_id, 6 - review_score, purchase_ts + INTERVAL 25 DAY, purchase_ts + INTERVAL 30 DAY
  FROM ord WHERE review_score IS NOT NULL AND order_id % 13 = 0
  UNION ALL SELECT order_id + 1000000000, order_id, 1, purchase_ts + INTERVAL 10 DAY, purchase_ts + INTERVAL 12 DAY
  FROM ord WHERE order_id % 17 = 0),
newest AS (SELECT * FROM rv QUALIFY row_number() OVER (
             PARTITION BY review_id ORDER BY answered DESC NULLS FIRST, created DESC, review_score DESC) = 1),
firsts AS (SELECT order_id, review_score AS score FROM newest QUALIFY row_number() OVER (
             PARTITION BY order_id ORDER BY created NULLS LAST, answered NULLS LAST, review_id) = 1)
"""

star_query("quality_null_profile",
           lambda star: reduce(DataFrame.unionByName, [quality.null_profile(star.tables()[t], t) for t in STAR_KEYS]), RAW_REVIEWS + """
, f AS (SELECT count(*) AS n, n - count(carrier_delivery_ts) AS carrier_delivery_ts,
               n - count(customer_delivery_ts) AS customer_delivery_ts, n - count(delivery_days) AS delivery_days,
               n - count(is_on_time) AS is_on_time, n - count(review_score) AS review_score FROM fact),
u AS (UNPIVOT f ON COLUMNS(* EXCLUDE (n)) INTO NAME column_name VALUE nulls)
SELECT 'fact_orders' AS table_name, n AS row_count, 18 AS column_count, column_name, nulls FROM u WHERE nulls > 0
UNION ALL
SELECT 'dim_products', count(*), 11, 'product_weight_g', count_if(product_weight_g IS NULL) FROM prod
UNION ALL SELECT 'dim_products', count(*), 11, 'embedding', count(*) FROM prod
UNION ALL SELECT 'dim_payments', count(*), 5, NULL, 0 FROM pay
UNION ALL SELECT 'dim_customers', count(*), 5, 'customer_zip_code', count(*) FROM cust
UNION ALL SELECT 'dim_sellers', count(*), 4, 'seller_zip_code', count(*) FROM sell
UNION ALL SELECT 'dim_date', date_diff('day', make_date(year(min(o_orderdate)), 1, 1),
                                       make_date(year(max(o_orderdate)), 12, 31)) + 1, 10, NULL, 0 FROM orders
UNION ALL SELECT 'dim_reviews', count(*), 7, unnest(['review_comment_title', 'review_comment']), count(*) FROM newest
UNION ALL SELECT 'dim_reviews', count(*), 7, 'review_answer_ts', count_if(answered IS NULL) FROM newest""")

query("quality_duplicate_profiles", lambda spark, folder: quality.duplicate_profiles({
    "orders": (commerce.table(spark, folder, "orders"), ["o_orderkey"]),
    "customer": (commerce.table(spark, folder, "customer"), ["c_custkey"]),
    "part": (commerce.table(spark, folder, "part"), ["p_partkey"]),
    "supplier": (commerce.table(spark, folder, "supplier"), ["s_suppkey"]),
    "lineitem": (commerce.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "payments": (commerce.raw_frames(spark, folder)["order_payments"], ["order_id", "payment_sequential"]),
    "reviews(review_id)": (commerce.raw_frames(spark, folder)["order_reviews"], ["review_id"]),
    "reviews(order_id)": (commerce.raw_frames(spark, folder)["order_reviews"], ["order_id"]),
}), STAR_SQL + """
, rv AS (
  SELECT order_id AS review_id, order_id FROM ord WHERE review_score IS NOT NULL
  UNION ALL SELECT order_id, order_id FROM ord WHERE review_score IS NOT NULL AND order_id % 13 = 0
  UNION ALL SELECT order_id + 1000000000, order_id FROM ord WHERE order_id % 17 = 0)
SELECT 'orders' AS table_name, 'o_orderkey' AS key_columns, count(*) AS row_count,
       count(*) - count(DISTINCT o_orderkey) AS duplicate_rows FROM orders
UNION ALL SELECT 'customer', 'c_custkey', count(*), count(*) - count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'part', 'p_partkey', count(*), count(*) - count(DISTINCT p_partkey) FROM part
UNION ALL SELECT 'supplier', 's_suppkey', count(*), count(*) - count(DISTINCT s_suppkey) FROM supplier
UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', count(*),
                 count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'payments', 'order_id,payment_sequential', count(*),
                 count(*) - count(DISTINCT (order_id, payment_sequential)) FROM pay
UNION ALL SELECT 'reviews(review_id)', 'review_id', count(*), count(*) - count(DISTINCT review_id) FROM rv
UNION ALL SELECT 'reviews(order_id)', 'order_id', count(*), count(*) - count(DISTINCT order_id) FROM rv""")

query("quality_join_inflation", lambda spark, folder: quality.join_inflation(
    commerce.order_facts(spark, folder), commerce.raw_frames(spark, folder)["order_reviews"], "order_id"), STAR_SQL + """
, rv AS (
  SELECT order_id FROM ord WHERE review_score IS NOT NULL
  UNION ALL SELECT order_id FROM ord WHERE review_score IS NOT NULL AND order_id % 13 = 0
  UNION ALL SELECT order_id FROM ord WHERE order_id % 17 = 0),
j AS (SELECT count(*) AS n FROM ord LEFT JOIN rv USING (order_id))
SELECT (SELECT count(*) FROM ord) AS left_rows, n AS joined_rows, n - (SELECT count(*) FROM ord) AS inflation FROM j""")

query("quality_payment_totals", lambda spark, folder: quality.with_payment_totals(
    commerce.order_facts(spark, folder).select("order_id", "order_status"),
    commerce.raw_frames(spark, folder)["order_payments"]).withColumn(
    "payment_total", F.col("payment_total").cast("double")), STAR_SQL + """
SELECT order_id, order_status, t::double AS payment_total, n AS n_payments
FROM ord LEFT JOIN (SELECT order_id, sum(payment_value) AS t, count(*) AS n FROM pay GROUP BY order_id)
USING (order_id)""")

# ---------------------------------------------------------------- checks

COUNTS = """
, rev AS (SELECT DISTINCT order_id AS review_id FROM ord WHERE review_score IS NOT NULL
          UNION ALL SELECT order_id + 1000000000 FROM ord WHERE order_id % 17 = 0),
n AS (SELECT 'fact_orders' AS table_name, count(*) AS n FROM fact UNION ALL SELECT 'dim_customers', count(*) FROM cust
      UNION ALL SELECT 'dim_products', count(*) FROM prod UNION ALL SELECT 'dim_sellers', count(*) FROM sell
      UNION ALL SELECT 'dim_reviews', count(*) FROM rev UNION ALL SELECT 'dim_payments', count(*) FROM pay
      UNION ALL SELECT 'dim_date', date_diff('day', make_date(year(min(o_orderdate)), 1, 1),
                                             make_date(year(max(o_orderdate)), 12, 31)) + 1 FROM orders)
"""
star_query("quality_row_counts", lambda star: quality.row_counts(star.tables()), COUNTS + """
SELECT * FROM n UNION ALL SELECT 'TOTAL', sum(n)::bigint FROM n""")


def _row_counts(spark, folder):
    """The source's counts as expectations: items, orders, and a product count that is off by one on purpose."""
    def rows(name, more=0):
        return (commerce.table(spark, folder, name).agg(F.count("*")).scalar() + more)

    expected = dict.fromkeys(STAR_KEYS) | {"fact_orders": rows("lineitem"), "dim_customers": rows("orders"),
                                           "dim_products": rows("part", 1)}
    return quality.row_count_check(commerce.star(spark, folder), expected)


query("quality_row_count_check", _row_counts, STAR_SQL + COUNTS + """
, x AS (SELECT 'fact_orders' AS table_name, count(*) AS e FROM lineitem
        UNION ALL SELECT 'dim_customers', count(*) FROM orders UNION ALL SELECT 'dim_products', count(*) + 1 FROM part)
SELECT table_name, n, e AS expected, if(e IS NULL, n > 0, n = e) AS ok FROM n LEFT JOIN x USING (table_name)""")


def _text(frame, *dates):
    """Dates as text: engines hand them to the caller in different types."""
    return frame.withColumns({c: F.col(c).cast("string") for c in dates})


DATES = """
SELECT min(purchase_ts)::date::varchar AS min_d, max(purchase_ts)::date::varchar AS max_d,
       count_if(year(purchase_ts) NOT BETWEEN 1996 AND 2000) AS out_of_range FROM fact"""
star_query("quality_date_range", lambda star: _text(
    quality.date_range(star, "1996-01-01", "2001-01-01"), "min_d", "max_d"), DATES)

star_query("quality_null_keys", quality.null_keys, """
SELECT count(*) - count(purchase_ts) AS null_ts, count(*) - count(price) AS null_price,
       count(*) - count(customer_id) AS null_cust,
       count_if(customer_delivery_ts IS NOT NULL AND delivery_days IS NULL) AS delivered_wo_days FROM fact""")

star_query("quality_duplicate_keys", quality.duplicate_keys, """
, f AS (SELECT count(*) AS c FROM (SELECT 1 FROM items SEMI JOIN ord USING (order_id)
                                   GROUP BY order_id, order_item_id HAVING count(*) > 1)),
c AS (SELECT count(*) AS c FROM (SELECT 1 FROM cust GROUP BY customer_id HAVING count(*) > 1)),
p AS (SELECT count(*) AS c FROM (SELECT 1 FROM prod GROUP BY product_id HAVING count(*) > 1))
SELECT f.c AS dup_fact, c.c AS dup_cust, p.c AS dup_prod, 0::bigint AS dup_rev, 0::bigint AS dup_dt FROM f, c, p""")

star_query("quality_referential_integrity", quality.referential_integrity, """
SELECT (SELECT count(*) FROM fact ANTI JOIN cust USING (customer_id)) AS orphan_cust,
       (SELECT count(*) FROM fact ANTI JOIN prod USING (product_id)) AS orphan_prod,
       (SELECT count(*) FROM fact ANTI JOIN sell USING (seller_id)) AS orphan_sell""")

query("quality_orders_without_items", lambda spark, folder: quality.orphans(
    commerce.table(spark, folder, "orders"), commerce.table(spark, folder, "lineitem").select("l_orderkey").distinct(),
    "o_orderkey", "l_orderkey"), """
SELECT count(*) AS orphans FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")

star_query("quality_impossible_values", lambda star: quality.impossible_values(star, 30), """
SELECT count_if(delivery_days < 0) AS negative_days, count_if(delivery_days > 30) AS slow_over_30d_info FROM fact""")

query("quality_join_cardinality", lambda spark, folder: quality.join_cardinality(
    commerce.star(spark, folder), commerce.table(spark, folder, "lineitem")), STAR_SQL + """
SELECT (SELECT count(*) FROM fact) AS fact_rows, (SELECT count(*) FROM lineitem) AS item_rows,
       (SELECT count(*) FROM fact) = (SELECT count(*) FROM lineitem) AS ok""")


def _suite(spark, folder):
    return quality.check_suite(commerce.star(spark, folder), dict.fromkeys(STAR_KEYS), "1995-01-01", "2002-01-01",
                               commerce.table(spark, folder, "lineitem"))


SUITE = STAR_SQL + COUNTS + """
, s AS (
  SELECT 'row counts' AS check_name, table_name AS metric, n AS value, NULL::bigint AS expected, n > 0 AS ok FROM n
  UNION ALL SELECT 'date range', 'out_of_range', count_if(year(purchase_ts) NOT BETWEEN 1995 AND 2001), 0,
                   count_if(year(purchase_ts) NOT BETWEEN 1995 AND 2001) = 0 FROM fact
  UNION ALL SELECT 'nulls in key columns', metric, v, 0, v = 0 FROM (UNPIVOT (
      SELECT count_if(purchase_ts IS NULL) AS null_ts, count_if(price IS NULL) AS null_price,
             count_if(customer_id IS NULL) AS null_cust,
             count_if(customer_delivery_ts IS NOT NULL AND delivery_days IS NULL) AS delivered_wo_days FROM fact)
      ON * INTO NAME metric VALUE v)
  UNION ALL SELECT 'duplicate keys', metric, c, 0, c = 0 FROM (
      SELECT 'dup_fact' AS metric, count(*) AS c
      FROM (SELECT 1 FROM fact GROUP BY order_id, order_item_id HAVING count(*) > 1)
      UNION ALL SELECT 'dup_cust', count(*) FROM (SELECT 1 FROM cust GROUP BY customer_id HAVING count(*) > 1)
      UNION ALL SELECT 'dup_prod', count(*) FROM (SELECT 1 FROM prod GROUP BY product_id HAVING count(*) > 1)
      UNION ALL SELECT 'dup_rev', count(*) FROM (SELECT 1 FROM rev GROUP BY review_id HAVING count(*) > 1)
      UNION ALL SELECT 'dup_dt', 0)
  UNION ALL SELECT 'referential integrity', 'orphan_cust', count(*), 0, count(*) = 0
            FROM fact ANTI JOIN cust USING (customer_id)
  UNION ALL SELECT 'referential integrity', 'orphan_prod', count(*), 0, count(*) = 0
            FROM fact ANTI JOIN prod USING (product_id)
  UNION ALL SELECT 'referential integrity', 'orphan_sell', count(*), 0, count(*) = 0
            FROM fact ANTI JOIN sell USING (seller_id)
  UNION ALL SELECT 'delivery days', 'negative_days', count_if(delivery_days < 0), 0, count_if(delivery_days < 0) = 0
            FROM fact
  UNION ALL SELECT 'delivery days', 'slow_over_90d_info', count_if(delivery_days > 90), NULL, true FROM fact
  UNION ALL SELECT 'join cardinality', 'missing_or_extra', count(*) - (SELECT count(*) FROM lineitem), 0,
                   count(*) = (SELECT count(*) FROM lineitem) FROM fact)
"""
query("quality_check_suite", _suite, SUITE + "SELECT * FROM s")


def _broken_suite(spark, folder):
    """The suite over rows that were spoilt on purpose: repeated items, missing prices, impossible days, lost products."""
    star = commerce.star(spark, folder)
    order = F.col("order_id")
    fact = star.fact_orders.withColumns({
        "price": F.when(order % 101 != 0, F.col("price")),
        "delivery_days": F.when(order % 103 == 0, -F.col("delivery_days")).otherwise(F.col("delivery_days"))})
    tables = {name: star.tables()[name] for name in STAR_KEYS}
    spoilt = Star(tables | {"fact_orders": fact.unionByName(fact.filter(order % 97 == 0)),
                            "dim_products": star.dim_products.filter("product_id % 89 <> 0")})
    return quality.verdict(quality.check_suite(spoilt, dict.fromkeys(STAR_KEYS), "1995-01-01", "2002-01-01",
                                               commerce.table(spark, folder, "lineitem")))


BROKEN = SUITE.replace("fact AS (\n  SELECT i.*, o.* EXCLUDE (order_id), price + freight_value AS rev FROM items i JOIN "
                       "ord o USING (order_id)),", """sound AS (
  SELECT i.* REPLACE (if(order_id % 101 = 0, NULL, price) AS price),
         o.* EXCLUDE (order_id) REPLACE (if(order_id % 103 = 0, -delivery_days, delivery_days) AS delivery_days),
         price + freight_value AS rev FROM items i JOIN ord o USING (order_id)),
fact AS (SELECT * FROM sound UNION ALL SELECT * FROM sound WHERE order_id % 97 = 0),""").replace(
    "starts_with(p_name, 'old ') THEN 'unknown' ELSE p_name END AS category,",
    "starts_with(p_name, 'old ') THEN 'unknown' ELSE p_name END AS category,").replace(
    "(p_size % 11 + 1)::double AS width_cm\n  FROM part)", "(p_size % 11 + 1)::double AS width_cm\n  FROM part "
    "WHERE p_partkey % 89 <> 0)")
query("quality_broken_verdict", _broken_suite, BROKEN + """
SELECT check_name, if(bool_and(ok), 'PASS', 'FAIL') AS result FROM s GROUP BY check_name
UNION ALL SELECT 'ALL', if(bool_and(ok), 'PASS', 'FAIL') FROM s""")
query("quality_verdict", lambda spark, folder: quality.verdict(_suite(spark, folder)), SUITE + """
SELECT check_name, if(bool_and(ok), 'PASS', 'FAIL') AS result FROM s GROUP BY check_name
UNION ALL SELECT 'ALL', if(bool_and(ok), 'PASS', 'FAIL') FROM s""")

star_query("quality_class_balance",
           lambda star: quality.class_balance(risk.with_label(risk.training_set(star))), """
, l AS (SELECT count(*) AS n, count_if(NOT is_on_time) AS late FROM fact WHERE is_delivered)
SELECT n, late, round(100.0::double * late / n, 1) AS late_rate_pct,
       NOT (100.0 * late / n > 1 AND 100.0 * late / n < 50) AS imbalanced FROM l""")

# ---------------------------------------------------------------- raw to star


def _raw(table, function):
    return lambda spark, folder: function(commerce.raw_frames(spark, folder)[table])


def _built(table, *columns):
    def run(spark, folder):
        star = build.build_star(spark, commerce.raw_frames(spark, folder), *commerce.calendar_days(spark, folder))
        return star.tables()[table].select(*columns) if columns else star.tables()[table]
    return run


query("etl_customers", _raw("customers", lambda raw: build.customers(raw).drop("customer_zip_code")),
      STAR_SQL + "SELECT * FROM cust")
query("etl_sellers", _raw("sellers", lambda raw: build.sellers(raw).select("seller_id", "seller_state")),
      STAR_SQL + "SELECT * FROM sell")
query("etl_products", lambda spark, folder: _built("dim_products")(spark, folder).drop("embedding"), """
SELECT p_partkey AS product_id, if(starts_with(p_name, 'new '), 'unknown', p_name) AS product_category_pt,
       if(starts_with(p_name, 'new ') OR starts_with(p_name, 'old '), 'unknown', upper(p_name))
         AS product_category_en,
       length(p_name)::int AS name_length, length(p_type)::int AS description_length, p_size % 5 AS photos_qty,
       if(p_partkey % 50 = 0, NULL, p_size * 100.0::double) AS product_weight_g, p_size::double AS length_cm,
       (p_size % 7 + 1)::double AS height_cm, (p_size % 11 + 1)::double AS width_cm FROM part""")
query("etl_payments", lambda spark, folder: build.payments(commerce.raw_frames(spark, folder)["order_payments"])
      .withColumn("payment_value", F.col("payment_value").cast("double")), STAR_SQL + """
SELECT order_id, payment_sequential, payment_type, payment_installments::int AS payment_installments,
       payment_value::double AS payment_value FROM pay""")

query("etl_reviews", lambda spark, folder: _text(_built(
    "dim_reviews", "review_id", "order_id", "review_score", "review_creation_date", "review_answer_ts")(spark, folder),
    "review_creation_date"), STAR_SQL + RAW_REVIEWS + """
SELECT review_id, order_id, review_score, created::date::varchar AS review_creation_date, answered AS review_answer_ts
FROM newest""")
query("etl_first_review_scores", _raw("order_reviews", lambda raw: build.first_review_scores(
    build.newest_reviews(build.parsed_reviews(raw)))), STAR_SQL + RAW_REVIEWS + """
SELECT order_id, score AS review_score FROM firsts""")


def _orders(spark, folder):
    raw = commerce.raw_frames(spark, folder)
    return build.enriched_orders(raw["orders"], build.newest_reviews(build.parsed_reviews(raw["order_reviews"])))


ORDER_COLUMNS = """order_status, purchase_ts, if(order_id % 50 = 0, NULL, approved_ts) AS approved_ts,
       carrier_delivery_ts, customer_delivery_ts, estimated_delivery_ts, purchase_date_key, delivery_days, is_delivered,
       is_on_time, score AS review_score"""
query("etl_orders", _orders, STAR_SQL + RAW_REVIEWS + f"""
SELECT order_id, customer_id, {ORDER_COLUMNS} FROM ord LEFT JOIN firsts USING (order_id)""")


def _fact(spark, folder):
    fact = _built("fact_orders")(spark, folder)
    return fact.withColumns({c: F.col(c).cast("double") for c in ("price", "freight_value")})


query("etl_fact_orders", _fact, STAR_SQL + RAW_REVIEWS + f"""
SELECT order_id, order_item_id, customer_id, product_id, seller_id, price::double AS price,
       freight_value::double AS freight_value, {ORDER_COLUMNS}
FROM fact LEFT JOIN firsts USING (order_id)""")


def _calendar(spark, folder):
    """The calendar of the years in which orders were placed."""
    return _text(build.calendar(spark, *commerce.calendar_days(spark, folder)), "full_date")


query("etl_calendar", _calendar, """
WITH b AS (SELECT date_trunc('year', min(o_orderdate))::date AS lo,
                  (date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR)::date AS hi FROM orders),
d AS (SELECT unnest(generate_series(lo, hi - 1, INTERVAL 1 DAY))::date AS d FROM b)
SELECT strftime(d, '%Y%m%d')::int AS date_key, d::varchar AS full_date, year(d)::int AS year, month(d)::int AS month,
       strftime(d, '%B') AS month_name, quarter(d)::int AS quarter, isodow(d)::int AS day_of_week,
       strftime(d, '%A') AS day_name, isodow(d) > 5 AS is_weekend, strftime(d, '%Y-%m') AS year_month FROM d""")
