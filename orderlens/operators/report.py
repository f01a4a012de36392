"""Datasets of the interactive report. Every function takes the filtered item view made by ``filtered_items``."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.measures import count_where, item_revenue, late, money, percent, share
from orderlens.operators.grain import first_item
from orderlens.operators.kpis import MIN_ORDERS
from orderlens.sources.star import Star

TOP = 15
# Labels shown in the report.
ONE_TIME, REPEAT = "One-time", "Repeat (2+ orders)"
OF_CUSTOMERS, OF_REVENUE = "% of customers", "% of revenue"
ON_TIME, LATE = "On-time", "Late"

# Constant within an order; the category is not, it belongs to the item.
ORDER_COLUMNS = ["month", "customer_state", "customer_unique_id", "delivery_days", "is_delivered", "is_on_time",
                 "review_score"]


@dataclass(frozen=True)
class Filters:
    """Inclusive purchase dates and allowed values; ``None`` allows everything that is not NULL."""

    date_from: date | None = None
    date_to: date | None = None
    states: tuple[str, ...] | None = None
    categories: tuple[str, ...] | None = None


def item_view(star: Star) -> DataFrame:
    """Wide view: item revenue with the order's dates and outcome, the buyer and the category."""
    fact = star.fact_orders.select("order_id", "order_item_id", "customer_id", "product_id", "purchase_ts",
                                   item_revenue().alias("item_revenue"), "delivery_days", "is_delivered",
                                   "is_on_time", "review_score")
    buyers = star.dim_customers.select("customer_id", "customer_state", "customer_unique_id")
    names = star.dim_products.select("product_id", F.col("product_category_en").alias("category"))
    return (fact.join(names, "product_id").join(buyers, "customer_id")
            .select("order_id", "order_item_id", "purchase_ts", "item_revenue", "delivery_days", "is_delivered",
                    "is_on_time", "review_score", "customer_state", "customer_unique_id", "category",
                    F.date_format("purchase_ts", "yyyy-MM").alias("month")))


def filtered_items(view: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """Date bounds are compared as timestamps, so they reach the scan; rows without state or category drop out."""
    keep = F.col("customer_state").isNotNull() & F.col("category").isNotNull() & F.col("purchase_ts").isNotNull()
    if filters.date_from is not None:
        keep = keep & (F.col("purchase_ts") >= F.lit(filters.date_from).cast("timestamp_ntz"))
    if filters.date_to is not None:
        keep = keep & (F.col("purchase_ts") < F.date_add(F.lit(filters.date_to), 1).cast("timestamp_ntz"))
    if filters.states is not None:
        keep = keep & F.col("customer_state").isin(list(filters.states))
    if filters.categories is not None:
        keep = keep & F.col("category").isin(list(filters.categories))
    return view.filter(keep)


def within_months(star: Star, filters: Filters) -> Star:
    """The star with its fact cut to the purchase months of the date filter.

    A stored fact is partitioned by ``purchase_month``; months outside the range are then never listed or read. A fact
    without that column is returned as it is. Use it before ``item_view``; the exact dates are still ``filtered_items``'.
    """
    if "purchase_month" not in star.fact_orders.columns:
        return star
    fact, month = star.fact_orders, F.col("purchase_month")
    for bound, keep in ((filters.date_from, month.__ge__), (filters.date_to, month.__le__)):
        if bound is not None:
            fact = fact.filter(keep(bound.year * 100 + bound.month))
    return star.with_fact(fact)


def filter_domains(view: DataFrame) -> DataFrame:
    """What can be filtered: (domain, value) with the first and last purchase date, all states and all categories.

    One pass reduces the view to its distinct (state, category) pairs with date bounds; the rest works on those.
    """
    pairs = view.groupBy("customer_state", "category").agg(F.min("purchase_ts").alias("lo"),
                                                           F.max("purchase_ts").alias("hi"))
    entries = pairs.select(F.inline(F.array(
        F.struct(F.lit("date").alias("domain"), F.lit(None).cast("string").alias("value"), "lo", "hi"),
        F.struct(F.lit("state").alias("domain"), F.col("customer_state").alias("value"), "lo", "hi"),
        F.struct(F.lit("category").alias("domain"), F.col("category").alias("value"), "lo", "hi"))))
    groups = entries.groupBy("domain", "value").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    dates = F.array(F.struct(F.lit("date_min").alias("domain"), F.col("lo").cast("date").cast("string").alias("value")),
                    F.struct(F.lit("date_max").alias("domain"), F.col("hi").cast("date").cast("string").alias("value")))
    other = F.array(F.struct("domain", "value"))
    return (groups.select(F.inline(F.when(F.col("domain") == "date", dates).otherwise(other)))
            .filter(F.col("value").isNotNull()).orderBy("domain", "value"))


def orders_view(items: DataFrame, *columns: str) -> DataFrame:
    """One row per order; the category is that of its lowest item id among the items that passed the filter.

    Name the order columns a report needs, so that only those are grouped and shuffled.
    """
    return first_item(items, list(columns or ORDER_COLUMNS), ["category"])


def order_outcomes(items: DataFrame, *columns: str) -> DataFrame:
    """One row per order without a category."""
    return items.select("order_id", *columns).distinct()


def kpi_cards(items: DataFrame) -> DataFrame:
    """Revenue, on-time share, mean score, repeat rate of the selection: items to orders to persons to one row."""
    orders = items.groupBy("order_id", "customer_unique_id", "is_delivered", "is_on_time", "review_score").agg(
        F.sum("item_revenue").alias("r"))
    people = orders.groupBy("customer_unique_id").agg(
        F.count("*").alias("n"), F.sum("r").alias("r"), F.sum("review_score").alias("score"),
        F.count("review_score").alias("scored"),
        count_where(F.col("is_delivered") & F.col("is_on_time").isNotNull()).alias("judged"),
        count_where(F.col("is_delivered") & F.col("is_on_time")).alias("on_time"))
    known = F.col("customer_unique_id").isNotNull()
    totals = people.agg(
        F.sum("r").alias("r"), F.sum("on_time").alias("on_time"), F.sum("judged").alias("judged"),
        F.sum("score").alias("score"), F.sum("scored").alias("scored"),
        count_where(known & (F.col("n") >= 2)).alias("repeat"), count_where(known).alias("people"))
    score = F.try_divide(F.col("score").cast("double"), F.col("scored").cast("double"))
    return totals.select(F.coalesce(money(F.col("r")), F.lit(0.0)).alias("revenue"),
                         percent(F.col("on_time"), F.col("judged"), 1).alias("on_time_pct"),
                         F.round(score, 2).alias("avg_score"),
                         percent(F.col("repeat"), F.col("people"), 1).alias("repeat_rate"))


def monthly_revenue(items: DataFrame) -> DataFrame:
    orders = items.groupBy("month", "order_id").agg(F.sum("item_revenue").alias("r"))
    return (orders.groupBy("month").agg(money(F.sum("r")).alias("revenue_brl"), F.count("*").alias("orders"))
            .orderBy("month"))


def _top_revenue(items: DataFrame, key: str, n: int) -> DataFrame:
    sums = items.groupBy(key).agg(F.sum("item_revenue").alias("r")).orderBy(F.desc("r"), key).limit(n)
    return sums.select(key, money(F.col("r")).alias("item_revenue"))


def top_states(items: DataFrame, n: int = TOP) -> DataFrame:
    return _top_revenue(items, "customer_state", n)


def top_categories(items: DataFrame, n: int = TOP) -> DataFrame:
    return _top_revenue(items, "category", n)


def delivery_days_by_state(items: DataFrame, min_orders: int = MIN_ORDERS) -> DataFrame:
    timed = order_outcomes(items.filter("delivery_days IS NOT NULL"), "customer_state", "delivery_days")
    national = timed.agg(F.avg("delivery_days")).scalar()
    return (timed.groupBy("customer_state").agg(F.round(F.avg("delivery_days"), 1).alias("avg_days"),
                                                F.count("*").alias("n"))
            .filter(F.col("n") >= min_orders).withColumn("natl_avg", F.round(national, 1))
            .orderBy("avg_days", "customer_state"))


def on_time_by_month(items: DataFrame) -> DataFrame:
    delivered = order_outcomes(items.filter("is_delivered"), "month", "is_on_time")
    months = delivered.groupBy("month").agg(count_where(F.col("is_on_time")).alias("on_time"),
                                            F.count("is_on_time").alias("judged"), F.count("*").alias("n"))
    totals = months.agg(percent(F.sum("on_time"), F.sum("judged"), 1)).scalar()
    return (months.select("month", percent(F.col("on_time"), F.col("judged"), 1).alias("on_time_pct"), "n",
                          totals.alias("overall")).orderBy("month"))


def late_by_category(items: DataFrame, n: int = TOP) -> DataFrame:
    late_orders = first_item(items.filter(F.col("is_delivered") & late()), [], ["category"])
    return (late_orders.groupBy("category").agg(F.count("*").alias("late_orders"))
            .orderBy(F.desc("late_orders"), "category").limit(n))


def score_distribution(items: DataFrame) -> DataFrame:
    reviewed = order_outcomes(items.filter("review_score IS NOT NULL"), "review_score")
    scores = reviewed.groupBy("review_score").agg(F.count("*").alias("orders"))
    return scores.select("review_score", "orders", share(F.col("orders")).alias("pct")).orderBy("review_score")


def scores_by_punctuality(items: DataFrame) -> DataFrame:
    judged = order_outcomes(items.filter("review_score IS NOT NULL AND is_on_time IS NOT NULL"),
                            "is_on_time", "review_score")
    return (judged.groupBy(F.when(F.col("is_on_time"), ON_TIME).otherwise(LATE).alias("label"))
            .agg(F.round(F.avg("review_score"), 2).alias("avg_score"), F.count("*").alias("n")).orderBy("label"))


def worst_reviewed_categories(items: DataFrame, min_orders: int = MIN_ORDERS, n: int = TOP) -> DataFrame:
    reviewed = orders_view(items.filter("review_score IS NOT NULL"), "review_score")
    cats = (reviewed.groupBy("category").agg(F.avg("review_score").alias("score"), F.count("*").alias("n"))
            .filter(F.col("n") >= min_orders).orderBy("score", "category").limit(n))
    return cats.select("category", F.round("score", 2).alias("avg_score"), "n").orderBy(F.desc("avg_score"), "category")


def _buyer_type(n):
    return F.when(n >= 2, REPEAT).otherwise(ONE_TIME)


def buyer_types(items: DataFrame) -> DataFrame:
    """Every order with its buyer's number of orders in the selection.

    The count is joined back instead of being a window over the person's orders: a person with very many orders is then a
    skewed join side, which is split at run time, and not one sorted group in one task.
    """
    orders = order_outcomes(items, "customer_unique_id")
    counts = orders.groupBy("customer_unique_id").agg(F.count("*").alias("n_orders_per_cust"))
    return orders.join(counts, "customer_unique_id").select(
        "order_id", "customer_unique_id", "n_orders_per_cust", _buyer_type(F.col("n_orders_per_cust")).alias("buyer_type"))


def _people(items: DataFrame) -> DataFrame:
    orders = items.groupBy("order_id", "customer_unique_id").agg(F.sum("item_revenue").alias("r"))
    return (orders.filter("customer_unique_id IS NOT NULL").groupBy("customer_unique_id")
            .agg(F.count("*").alias("n"), F.sum("r").alias("r")))


def buyer_shares(items: DataFrame) -> DataFrame:
    """Share of customers and share of revenue of both buyer types; a type nobody belongs to shows 0."""
    repeat = F.col("n") >= 2
    sums = _people(items).agg(
        count_where(repeat).alias("repeat_n"), count_where(~repeat).alias("one_n"), F.count("*").alias("n"),
        F.coalesce(F.sum(F.when(repeat, F.col("r"))), F.lit(0)).alias("repeat_r"),
        F.coalesce(F.sum(F.when(~repeat, F.col("r"))), F.lit(0)).alias("one_r"), F.sum("r").alias("r"))

    def row(kind, label, part, whole):
        return F.struct(F.lit(kind).alias("buyer_type"), F.lit(label).alias("share_type"),
                        percent(F.col(part), F.col(whole), 1).alias("pct"))

    return sums.select(F.inline(F.array(
        row(ONE_TIME, OF_CUSTOMERS, "one_n", "n"), row(ONE_TIME, OF_REVENUE, "one_r", "r"),
        row(REPEAT, OF_CUSTOMERS, "repeat_n", "n"), row(REPEAT, OF_REVENUE, "repeat_r", "r"))))


def orders_per_customer(items: DataFrame, cap: int = 5) -> DataFrame:
    capped = F.least(F.col("n"), F.lit(cap))
    label = F.when(F.col("k") == cap, F.lit(f"{cap}+")).otherwise(F.col("k").cast("string"))
    return (_people(items).groupBy(capped.alias("k")).agg(F.count("*").alias("customers"))
            .orderBy("k").select(label.alias("orders"), "customers"))
