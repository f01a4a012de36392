"""The fifteen KPI reports.

Order-level reports collapse the fact to one row per order before anything is joined, so joins and counts see orders.
Revenue reports pre-aggregate items to orders first. Windows run only over finished groups (months, states, types).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.measures import count_where, item_revenue, late, mean, money, percent, share
from orderlens.functions.percentiles import percentile_of_counts, value_counts
from orderlens.operators.grain import order_grain, order_money, person_orders
from orderlens.sources.star import Star

MIN_ORDERS = 200
TOP_N = 10
# Upper edges in days (inclusive) and labels of the delivery buckets; the last label has no edge.
DELIVERY_BUCKETS = [
    (3, "1. 0-3 days (fast)"),
    (7, "2. 4-7 days"),
    (14, "3. 8-14 days"),
    (30, "4. 15-30 days"),
    (60, "5. 31-60 days"),
    (None, "6. 60+ days (very late)"),
]


def with_month(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Adds ``year_month``; rows whose purchase day is outside the calendar drop out."""
    months = dates.select(F.col("date_key").alias("purchase_date_key"), "year_month")
    return orders.join(months, "purchase_date_key")


def with_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers.select("customer_id", "customer_state"), "customer_id")


def with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select("product_id", F.col("product_category_en").alias("category"))
    return items.join(names, "product_id")


def revenue_by_month(star: Star) -> DataFrame:
    orders = order_money(star.fact_orders, "purchase_date_key")
    return (with_month(orders, star.dim_date).groupBy("year_month")
            .agg(F.count("*").alias("orders"), money(F.sum("order_revenue")).alias("revenue_brl"))
            .orderBy("year_month"))


def revenue_by_state(star: Star) -> DataFrame:
    orders = order_money(star.fact_orders, "customer_id")
    states = (with_state(orders, star.dim_customers).groupBy("customer_state")
              .agg(F.count("*").alias("orders"), F.sum("order_revenue").alias("revenue")))
    return (states.select("customer_state", "orders", money(F.col("revenue")).alias("revenue_brl"),
                          share(F.col("revenue")).alias("pct_of_total"))
            .orderBy(F.desc("revenue_brl"), "customer_state"))


def category_revenue(star: Star) -> DataFrame:
    """Revenue and distinct orders of every category; an order counts once in each category it touches."""
    per_order = (with_category(star.fact_orders.select("order_id", "product_id", item_revenue().alias("r")),
                               star.dim_products)
                 .groupBy("category", "order_id").agg(F.sum("r").alias("r")))
    return per_order.groupBy("category").agg(F.count("*").alias("orders"), F.sum("r").alias("revenue"))


def category_money(star: Star) -> DataFrame:
    """Revenue only: items are summed per product before the catalogue is joined."""
    per_product = star.fact_orders.groupBy("product_id").agg(F.sum(item_revenue()).alias("r"))
    return with_category(per_product, star.dim_products).groupBy("category").agg(F.sum("r").alias("revenue"))


def revenue_by_category(star: Star) -> DataFrame:
    return (category_revenue(star).select("category", "orders", money(F.col("revenue")).alias("revenue_brl"))
            .orderBy(F.desc("revenue_brl"), "category"))


def on_time_rate(star: Star) -> DataFrame:
    delivered = order_grain(star.fact_orders.filter("is_delivered"), "is_on_time")
    counts = delivered.agg(F.count("*").alias("delivered_orders"),
                           count_where(F.col("is_on_time")).alias("on_time_orders"),
                           count_where(late()).alias("late_orders"))
    return counts.select("delivered_orders", "on_time_orders",
                         percent(F.col("on_time_orders"), F.col("delivered_orders"), 2).alias("on_time_pct"),
                         "late_orders")


def delivery_days_by_month(star: Star) -> DataFrame:
    """Mean and exact median days; both come from one count of orders per month and duration."""
    delivered = order_grain(star.fact_orders.filter("delivery_days IS NOT NULL"), "purchase_date_key", "delivery_days")
    counts = value_counts(with_month(delivered, star.dim_date), ["year_month"], "delivery_days")
    averages = counts.groupBy("year_month").agg(
        F.sum("n").alias("delivered_orders"),
        F.round(F.sum(F.col("value") * F.col("n")) / F.sum("n"), 1).alias("avg_delivery_days"))
    medians = percentile_of_counts(counts, ["year_month"], 0.5, name="m")
    return (averages.join(medians, "year_month")
            .select("year_month", "delivered_orders", "avg_delivery_days",
                    F.round("m", 1).alias("median_delivery_days"))
            .orderBy("year_month"))


def review_scores(star: Star) -> DataFrame:
    reviewed = order_grain(star.fact_orders.filter("review_score IS NOT NULL"), "review_score")
    stars = [count_where(F.col("review_score") == s).alias(f"score_{s}") for s in range(1, 6)]
    return reviewed.agg(F.count("*").alias("reviewed_orders"),
                        F.round(F.avg("review_score"), 2).alias("avg_review_score"), *stars)


def repeat_rate(star: Star, digits: int = 2) -> DataFrame:
    people = person_orders(star.fact_orders, star.dim_customers)
    counts = people.agg(F.count("*").alias("total_customers"),
                        count_where(F.col("n_orders") >= 2).alias("repeat_customers"),
                        F.sum("n_orders").alias("n"))
    return counts.select("total_customers", "repeat_customers",
                         percent(F.col("repeat_customers"), F.col("total_customers"), 2).alias("repeat_rate_pct"),
                         mean(F.col("n"), F.col("total_customers"), digits).alias("avg_orders_per_customer"))


def reviews_by_punctuality(star: Star) -> DataFrame:
    judged = order_grain(star.fact_orders.filter("is_on_time IS NOT NULL AND review_score IS NOT NULL"),
                         "is_on_time", "review_score")
    groups = judged.groupBy("is_on_time").agg(F.count("*").alias("orders"),
                                              F.round(F.avg("review_score"), 2).alias("avg_review_score"),
                                              count_where(F.col("review_score") == 1).alias("ones"))
    return (groups.select("is_on_time", "orders", "avg_review_score",
                          percent(F.col("ones"), F.col("orders"), 1).alias("pct_1star"))
            .orderBy(F.desc("is_on_time")))


def top_categories(star: Star, top_n: int = TOP_N) -> DataFrame:
    """Largest categories with share and running share, both taken from revenue already rounded to cents.

    The top rows are found by a distributed top-k; only they enter the running window.
    """
    rounded = category_money(star).select("category", F.round("revenue", 2).alias("revenue"))
    total = rounded.agg(F.sum("revenue")).scalar()
    top = rounded.orderBy(F.desc("revenue"), "category").limit(top_n).withColumn("total", total)
    running = F.sum("revenue").over(Window.orderBy(F.desc("revenue"), "category")
                                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (top.select("category", money(F.col("revenue")).alias("revenue_brl"),
                       percent(F.col("revenue"), F.col("total"), 1).alias("pct_of_total"),
                       percent(running, F.col("total"), 1).alias("cumulative_pct"))
            .orderBy(F.desc("revenue_brl"), "category"))


def delivery_bucket(days: Column) -> Column:
    """Bucket label of fractional days: 3.2 days is already in the second bucket."""
    label = None
    for edge, name in DELIVERY_BUCKETS[:-1]:
        label = F.when(days <= edge, name) if label is None else label.when(days <= edge, name)
    return label.otherwise(DELIVERY_BUCKETS[-1][1])


def delivery_distribution(star: Star) -> DataFrame:
    delivered = order_grain(star.fact_orders.filter("delivery_days IS NOT NULL"), "delivery_days")
    buckets = (delivered.groupBy(delivery_bucket(F.col("delivery_days")).alias("delivery_bucket"))
               .agg(F.count("*").alias("orders")))
    return (buckets.select("delivery_bucket", "orders", share(F.col("orders")).alias("pct_of_delivered"))
            .orderBy("delivery_bucket"))


def payment_types(star: Star) -> DataFrame:
    return payment_types_of(star.dim_payments)


def payment_types_of(payments: DataFrame) -> DataFrame:
    """Payments only, never joined to items. Rows are reduced to (type, order) before the distinct count."""
    per_order = payments.groupBy("payment_type", "order_id").agg(
        F.count("*").alias("rows"), F.sum("payment_value").alias("value"),
        F.sum("payment_installments").alias("installments"), F.count("payment_installments").alias("n"))
    types = per_order.groupBy("payment_type").agg(
        F.count("*").alias("orders"), F.sum("rows").alias("payment_rows"), F.sum("value").alias("value"),
        F.sum("installments").alias("installments"), F.sum("n").alias("n"))
    return (types.select("payment_type", "orders", "payment_rows", money(F.col("value")).alias("paid_brl"),
                         share(F.col("value")).alias("pct_of_value"),
                         mean(F.col("installments"), F.col("n"), 1).alias("avg_installments"))
            .orderBy(F.desc("paid_brl"), "payment_type"))


def revenue_by_buyer_type(star: Star, label: str, repeat: str, one_time: str) -> DataFrame:
    """Revenue of repeat and one-time buyers: two nested aggregations by person and type, without a join back."""
    people = person_orders(star.fact_orders, star.dim_customers)
    types = (people.groupBy(F.when(F.col("n_orders") >= 2, repeat).otherwise(one_time).alias(label))
             .agg(F.sum("n_orders").alias("orders"), F.sum("revenue").alias("revenue")))
    return (types.select(label, "orders", money(F.col("revenue")).alias("revenue_brl"),
                         share(F.col("revenue")).alias("pct_of_revenue"))
            .orderBy(F.desc("revenue_brl")))


def repeat_vs_one_time_revenue(star: Star) -> DataFrame:
    return revenue_by_buyer_type(star, "customer_type", "repeat_customer", "one_time_customer")


def _punctuality(groups: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Delivered orders, on-time share and mean days of frames with one row per unit to count."""
    counts = groups.groupBy(key).agg(F.count("*").alias("delivered_orders"),
                                     count_where(F.col("is_on_time")).alias("on_time"),
                                     F.round(F.avg("delivery_days"), 1).alias("avg_delivery_days"))
    return counts.select(key, "delivered_orders",
                         percent(F.col("on_time"), F.col("delivered_orders"), digits).alias("on_time_pct"),
                         "avg_delivery_days")


def delivered_by_state(star: Star) -> DataFrame:
    delivered = order_grain(star.fact_orders.filter("is_delivered"), "customer_id", "is_on_time", "delivery_days")
    return _punctuality(with_state(delivered, star.dim_customers), "customer_state")


def worst_states(star: Star, min_orders: int = MIN_ORDERS) -> DataFrame:
    return (delivered_by_state(star).filter(F.col("delivered_orders") >= min_orders)
            .orderBy(F.asc_nulls_last("on_time_pct"), F.desc("delivered_orders"), "customer_state"))


def worst_categories(star: Star, min_orders: int = MIN_ORDERS) -> DataFrame:
    """Counts (order, product) pairs: an order with two products of a category counts twice in it."""
    pairs = (star.fact_orders.filter("is_delivered")
             .select("order_id", "product_id", "is_on_time", "delivery_days").distinct())
    return (_punctuality(with_category(pairs, star.dim_products), "category")
            .filter(F.col("delivered_orders") >= min_orders)
            .orderBy(F.asc_nulls_last("on_time_pct"), F.desc("delivered_orders"), "category"))


def monthly_experience(star: Star) -> DataFrame:
    """Every delivered order counts; orders without a review only leave the score's mean unchanged."""
    delivered = order_grain(star.fact_orders.filter("is_delivered"), "purchase_date_key", "is_on_time",
                            "review_score", "delivery_days")
    months = with_month(delivered, star.dim_date).groupBy("year_month").agg(
        F.count("*").alias("orders"), count_where(F.col("is_on_time")).alias("on_time"),
        F.round(F.avg("review_score"), 2).alias("avg_review_score"),
        F.round(F.avg("delivery_days"), 1).alias("avg_delivery_days"))
    return (months.select("year_month", "orders", percent(F.col("on_time"), F.col("orders"), 1).alias("on_time_pct"),
                          "avg_review_score", "avg_delivery_days")
            .orderBy("year_month"))


def reports(star: Star) -> dict[str, DataFrame]:
    """All KPI reports by the name they are stored under; run them with ``run_corpus``."""
    # Names of the stored reports.
    return {
        "01_revenue_by_month": revenue_by_month(star),
        "02_revenue_by_state": revenue_by_state(star),
        "03_revenue_by_category": revenue_by_category(star),
        "04_on_time_delivery_pct": on_time_rate(star),
        "05_avg_delivery_days": delivery_days_by_month(star),
        "06_avg_review_score": review_scores(star),
        "07_repeat_purchase_rate": repeat_rate(star),
        "08_late_vs_ontime_review_scores": reviews_by_punctuality(star),
        "09_top10_categories": top_categories(star),
        "10_delivery_days_distribution": delivery_distribution(star),
        "11_payment_types": payment_types(star),
        "12_repeat_vs_onetime_revenue": repeat_vs_one_time_revenue(star),
        "13_worst_states_on_time": worst_states(star),
        "14_worst_categories_on_time": worst_categories(star),
        "15_monthly_ontime_vs_reviews": monthly_experience(star),
    }
