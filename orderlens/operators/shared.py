"""Many reports from one pass over the fact.

The fact is read once, into one row per order and product. Orders, buyers and categories are sums over that table, and one
``GROUPING SETS`` aggregation over the orders counts them by month, by state, by outcome, by delivery bucket and in all at
the same time: a row of it holds every sum any report needs. Reports are then a few expressions over tables of a few hundred
rows, under the same names and with the same rows as those of ``kpis`` and ``explore``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.measures import count_where, item_revenue, late, mean, money, percent, share
from orderlens.functions.percentiles import percentile_of_counts, value_counts
from orderlens.operators import kpis
from orderlens.operators.explore import ONE_TIME, REPEAT
from orderlens.operators.kpis import MIN_ORDERS, TOP_N
from orderlens.session import scratch_path
from orderlens.sources.star import Star

ORDER = ["order_id", "customer_id", "purchase_date_key", "is_delivered", "is_on_time", "delivery_days", "review_score"]
#: The sets the orders are counted by; the flags tell orders of a known month or buyer from the others.
SETS = {"all": [], "month": ["year_month", "dated"], "state": ["customer_state", "known"],
        "outcome": ["is_on_time", "review_score"], "bucket": ["delivery_bucket"]}


@dataclass(frozen=True)
class Shared:
    """Stored tables: orders (one row each), cube (sums by the sets), buyers (one-time and repeat), categories, payments."""

    orders: DataFrame
    cube: DataFrame
    buyers: DataFrame
    categories: DataFrame
    payments: DataFrame


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def order_products(star: Star) -> DataFrame:
    """One row per order and product with the order's columns: the only read of the fact."""
    return star.fact_orders.groupBy(*ORDER, "product_id").agg(F.sum(item_revenue()).alias("r"))


def _sums() -> list[Column]:
    timed, days, score = F.col("delivery_days").isNotNull(), F.col("delivery_days"), F.col("review_score")
    delivered = F.col("is_delivered")
    return [F.count("*").alias("orders"), F.sum("r").alias("revenue"), count_where(delivered).alias("delivered"),
            count_where(delivered & F.col("is_on_time")).alias("on_time"), count_where(delivered & late()).alias("late"),
            F.sum(F.when(delivered, days)).alias("delivered_days"), count_where(delivered & timed).alias("delivered_timed"),
            F.sum(days).alias("days"), count_where(timed).alias("timed"),
            F.sum(F.when(delivered, score)).alias("delivered_score"),
            count_where(delivered & score.isNotNull()).alias("delivered_scored")]


def counted(orders: DataFrame) -> DataFrame:
    """All sums of the orders by every set at once; ``grouped`` names the set of a row."""
    columns = list(dict.fromkeys(c for s in SETS.values() for c in s))
    names = F.lit(None).cast("string")
    for name, inside in SETS.items():
        bits = sum((0 if c in inside else 1) << (len(columns) - 1 - i) for i, c in enumerate(columns))
        names = F.when(F.grouping_id(*columns) == bits, name).otherwise(names)
    return orders.groupingSets([[F.col(c) for c in s] for s in SETS.values()], *columns).agg(names.alias("grouped"), *_sums())


def share_scan(star: Star) -> Shared:
    """Reads the fact once and stores what the reports need."""
    pairs = _written(order_products(star), "order-products")
    months = star.dim_date.select(F.col("date_key").alias("purchase_date_key"), "year_month", F.lit(True).alias("dated"))
    buyers = star.dim_customers.select("customer_id", "customer_unique_id", "customer_state", F.lit(True).alias("known"))
    bucket = F.when(F.col("delivery_days").isNotNull(), kpis.delivery_bucket(F.col("delivery_days")))
    orders = _written(pairs.groupBy(*ORDER).agg(F.sum("r").alias("r")).join(months, "purchase_date_key", "left")
                      .join(buyers, "customer_id", "left").withColumn("delivery_bucket", bucket), "shared-orders")
    people = orders.filter("known").groupBy("customer_unique_id").agg(F.count("*").alias("n"), F.sum("r").alias("r"))
    types = people.groupBy((F.col("n") >= 2).alias("repeat")).agg(
        F.count("*").alias("people"), F.sum("n").alias("orders"), F.sum("r").alias("revenue"))
    named = kpis.with_category(pairs, star.dim_products)
    per_order = named.groupBy("category", "order_id").agg(
        F.sum("r").alias("r"), count_where(F.col("is_delivered")).alias("delivered"),
        count_where(F.col("is_delivered") & F.col("is_on_time")).alias("on_time"),
        F.sum(F.when(F.col("is_delivered"), F.col("delivery_days"))).alias("days"),
        count_where(F.col("is_delivered") & F.col("delivery_days").isNotNull()).alias("timed"))
    categories = per_order.groupBy("category").agg(
        F.count("*").alias("orders"), F.sum("r").alias("revenue"), F.sum("delivered").alias("delivered"),
        F.sum("on_time").alias("on_time"), F.sum("days").alias("days"), F.sum("timed").alias("timed"))
    return Shared(orders, *(_written(t, "shared") for t in (counted(orders), types, categories)), star.dim_payments)


def _ratio(total: str, n: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(n).cast("double"))


def _of(shared: Shared, grouped: str) -> DataFrame:
    rows = shared.cube.filter(F.col("grouped") == grouped)
    return rows.filter({"month": "dated", "state": "known"}.get(grouped, "true"))


def _orders_by_month(shared: Shared) -> DataFrame:
    return (_of(shared, "month").select("year_month", "orders", money(F.col("revenue")).alias("revenue_brl"))
            .orderBy("year_month"))


def _on_time(shared: Shared) -> DataFrame:
    delivered, on_time, late_ = (F.coalesce(F.sum(c), F.lit(0)) for c in ("delivered", "on_time", "late"))
    return _of(shared, "all").agg(delivered.alias("delivered_orders"), on_time.alias("on_time_orders"),
                                  percent(on_time, delivered, 2).alias("on_time_pct"), late_.alias("late_orders"))


def _days_by_month(shared: Shared) -> DataFrame:
    counts = value_counts(shared.orders.filter("dated"), ["year_month"], "delivery_days")
    medians = percentile_of_counts(counts, ["year_month"], 0.5, name="m")
    return (_of(shared, "month").join(medians, "year_month").select(
        "year_month", F.col("timed").alias("delivered_orders"), F.round(_ratio("days", "timed"), 1).alias("avg_delivery_days"),
        F.round("m", 1).alias("median_delivery_days")).orderBy("year_month"))


def _scores(shared: Shared) -> DataFrame:
    reviewed = _of(shared, "outcome").filter("review_score IS NOT NULL")
    stars = [F.coalesce(F.sum(F.when(F.col("review_score") == s, F.col("orders"))), F.lit(0)).alias(f"score_{s}")
             for s in range(1, 6)]
    total = F.sum(F.col("review_score") * F.col("orders")).cast("double")
    n = F.coalesce(F.sum("orders"), F.lit(0))
    return reviewed.agg(n.alias("reviewed_orders"), F.round(F.try_divide(total, n.cast("double")), 2).alias("avg_review_score"),
                        *stars)


def _repeat(shared: Shared, digits: int) -> DataFrame:
    people = F.coalesce(F.sum("people"), F.lit(0))
    repeat = F.coalesce(F.sum(F.when(F.col("repeat"), F.col("people"))), F.lit(0))
    return shared.buyers.agg(people.alias("total_customers"), repeat.alias("repeat_customers"),
                             percent(repeat, people, 2).alias("repeat_rate_pct"),
                             mean(F.sum("orders"), people, digits).alias("avg_orders_per_customer"))


def _by_punctuality(shared: Shared) -> DataFrame:
    n, one = F.sum("orders"), F.coalesce(F.sum(F.when(F.col("review_score") == 1, F.col("orders"))), F.lit(0))
    total = F.sum(F.col("review_score") * F.col("orders")).cast("double")
    return (_of(shared, "outcome").filter("is_on_time IS NOT NULL AND review_score IS NOT NULL").groupBy("is_on_time")
            .agg(n.alias("orders"), F.round(total / n.cast("double"), 2).alias("avg_review_score"),
                 percent(one, n, 1).alias("pct_1star")).orderBy(F.desc("is_on_time")))


def _top_categories(shared: Shared, n: int = TOP_N) -> DataFrame:
    rounded = shared.categories.select("category", F.round("revenue", 2).alias("revenue"))
    whole = Window.partitionBy()  # categories
    running = F.sum("revenue").over(Window.orderBy(F.desc("revenue"), "category")
                                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = rounded.select("category", "revenue", F.sum("revenue").over(whole).alias("total"), running.alias("upto"))
    return (ranked.orderBy(F.desc("revenue"), "category").limit(n)
            .select("category", money(F.col("revenue")).alias("revenue_brl"),
                    percent(F.col("revenue"), F.col("total"), 1).alias("pct_of_total"),
                    percent(F.col("upto"), F.col("total"), 1).alias("cumulative_pct"))
            .orderBy(F.desc("revenue_brl"), "category"))


def _buckets(shared: Shared) -> DataFrame:
    return (_of(shared, "bucket").filter("delivery_bucket IS NOT NULL")
            .select("delivery_bucket", "orders", share(F.col("orders")).alias("pct_of_delivered")).orderBy("delivery_bucket"))


def _buyer_revenue(shared: Shared, label: str, repeat: str, one_time: str) -> DataFrame:
    return (shared.buyers.select(F.when(F.col("repeat"), repeat).otherwise(one_time).alias(label), "orders",
                                 money(F.col("revenue")).alias("revenue_brl"), share(F.col("revenue")).alias("pct_of_revenue"))
            .orderBy(F.desc("revenue_brl")))


def _delivered(rows: DataFrame, key: str, days: str, timed: str, min_orders: int) -> DataFrame:
    return (rows.filter(F.col("delivered") >= F.greatest(F.lit(min_orders), F.lit(1)))
            .select(key, F.col("delivered").alias("delivered_orders"),
                    percent(F.col("on_time"), F.col("delivered"), 1).alias("on_time_pct"),
                    F.round(_ratio(days, timed), 1).alias("avg_delivery_days"))
            .orderBy(F.asc_nulls_last("on_time_pct"), F.desc("delivered_orders"), key))


def _states(shared: Shared, min_orders: int) -> DataFrame:
    return _delivered(_of(shared, "state"), "customer_state", "delivered_days", "delivered_timed", min_orders)


def _experience(shared: Shared) -> DataFrame:
    return (_of(shared, "month").filter("delivered > 0").select(
        "year_month", F.col("delivered").alias("orders"), percent(F.col("on_time"), F.col("delivered"), 1).alias("on_time_pct"),
        F.round(_ratio("delivered_score", "delivered_scored"), 2).alias("avg_review_score"),
        F.round(_ratio("delivered_days", "delivered_timed"), 1).alias("avg_delivery_days")).orderBy("year_month"))


def kpi_reports(shared: Shared) -> dict[str, DataFrame]:
    """``kpis.reports`` from the shared tables."""
    states = _of(shared, "state").select("customer_state", "orders", money(F.col("revenue")).alias("revenue_brl"),
                                         share(F.col("revenue")).alias("pct_of_total"))
    return {
        "01_revenue_by_month": _orders_by_month(shared),
        "02_revenue_by_state": states.orderBy(F.desc("revenue_brl"), "customer_state"),
        "03_revenue_by_category": shared.categories.select("category", "orders", money(F.col("revenue")).alias("revenue_brl"))
        .orderBy(F.desc("revenue_brl"), "category"),
        "04_on_time_delivery_pct": _on_time(shared),
        "05_avg_delivery_days": _days_by_month(shared),
        "06_avg_review_score": _scores(shared),
        "07_repeat_purchase_rate": _repeat(shared, 2),
        "08_late_vs_ontime_review_scores": _by_punctuality(shared),
        "09_top10_categories": _top_categories(shared),
        "10_delivery_days_distribution": _buckets(shared),
        "11_payment_types": kpis.payment_types_of(shared.payments),
        "12_repeat_vs_onetime_revenue": _buyer_revenue(shared, "customer_type", "repeat_customer", "one_time_customer"),
        "13_worst_states_on_time": _states(shared, MIN_ORDERS),
        "14_worst_categories_on_time": _delivered(shared.categories, "category", "days", "timed", MIN_ORDERS),
        "15_monthly_ontime_vs_reviews": _experience(shared),
    }


def _extremes(shared: Shared, n: int) -> DataFrame:
    best_first = Window.orderBy(F.desc("revenue"), F.asc("category"))  # categories
    ranked = shared.categories.select("category", "orders", F.round("revenue", 2).alias("revenue")).select(
        "*", F.row_number().over(best_first).cast("bigint").alias("rank_desc"), F.count("*").over(Window.partitionBy()).alias("of"))
    top = F.col("rank_desc") <= n
    return (ranked.filter(top | (F.col("rank_desc") > F.col("of") - n))
            .select(F.when(top, f"top{n}").otherwise(f"bottom{n}").alias("side"), "rank_desc", "category",
                    money(F.col("revenue")).alias("revenue_brl"), "orders").orderBy("rank_desc"))


def _days_by_state(shared: Shared, min_orders: int) -> DataFrame:
    national = _of(shared, "all").select(_ratio("days", "timed")).scalar()
    states = _of(shared, "state").filter(F.col("timed") >= F.greatest(F.lit(min_orders), F.lit(1))).select(
        "customer_state", F.col("timed").alias("delivered_orders"),
        F.round(_ratio("days", "timed"), 1).alias("avg_delivery_days")).withColumn("natl_avg", national)
    return (states.withColumn("days_vs_natl_avg", F.round(F.col("avg_delivery_days") - F.col("natl_avg"), 1))
            .orderBy(F.desc("avg_delivery_days"), "customer_state"))


def explore_reports(shared: Shared, min_orders: int = MIN_ORDERS, n: int = TOP_N) -> dict[str, DataFrame]:
    """``explore.reports`` from the shared tables."""
    scores = (_of(shared, "outcome").filter("review_score IS NOT NULL").groupBy("review_score")
              .agg(F.sum("orders").alias("orders")))
    return {
        "01_monthly_revenue": _orders_by_month(shared),
        "02_category_rank_top_bottom": _extremes(shared, n),
        "03a_ontime_overall": _on_time(shared).drop("late_orders"),
        "03b_ontime_by_state": _states(shared, min_orders).drop("avg_delivery_days")
        .orderBy(F.asc_nulls_last("on_time_pct"), "customer_state"),
        "04_delivery_days_by_state": _days_by_state(shared, min_orders),
        "05a_review_score_distribution": scores.select("review_score", "orders", share(F.col("orders")).alias("pct"))
        .orderBy("review_score"),
        "05b_late_vs_ontime_reviews": _by_punctuality(shared),
        "06_repeat_purchase_rate": _repeat(shared, 3),
        "07_revenue_repeat_vs_onetime": _buyer_revenue(shared, "buyer_type", REPEAT, ONE_TIME),
    }
