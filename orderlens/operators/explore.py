"""Exploratory reports, their one-row roll-up and the derived what-if figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.measures import count_where, late, money, percent, share
from orderlens.operators import kpis
from orderlens.operators.grain import order_grain, order_money, person_orders
from orderlens.operators.kpis import MIN_ORDERS, TOP_N
from orderlens.sources.star import Star

REPEAT, ONE_TIME = "repeat", "one_time"


def category_extremes(star: Star, n: int = TOP_N) -> DataFrame:
    """The first and last ``n`` categories by revenue with their rank.

    Both ends come from a distributed top-k, so no task ranks the whole list; ranks at the lower end are counted back
    from the number of categories. With fewer than 2n categories none appears twice.
    """
    cats = kpis.category_revenue(star).select("category", "orders", F.round("revenue", 2).alias("revenue"))
    # Counting a sum of both columns keeps them in the plan, so the count reads the same aggregate as the two top-k.
    number = cats.agg(F.count(F.col("revenue") + F.col("orders"))).scalar()
    best_first = [F.desc("revenue"), F.asc("category")]
    worst_first = [F.asc("revenue"), F.desc("category")]
    top = cats.orderBy(*best_first).limit(n).withColumn("rank_desc", F.row_number().over(Window.orderBy(*best_first)))
    bottom = (cats.orderBy(*worst_first).limit(n)
              .withColumn("rank_desc", number - F.row_number().over(Window.orderBy(*worst_first)) + 1)
              .filter(F.col("rank_desc") > n))
    return (top.withColumn("side", F.lit(f"top{n}"))
            .unionByName(bottom.withColumn("side", F.lit(f"bottom{n}")))
            .select("side", F.col("rank_desc").cast("bigint").alias("rank_desc"), "category",
                    money(F.col("revenue")).alias("revenue_brl"), "orders")
            .orderBy("rank_desc"))


def on_time_overall(star: Star) -> DataFrame:
    return kpis.on_time_rate(star).drop("late_orders")


def on_time_by_state(star: Star, min_orders: int = MIN_ORDERS) -> DataFrame:
    return (kpis.delivered_by_state(star).filter(F.col("delivered_orders") >= min_orders)
            .select("customer_state", "delivered_orders", "on_time_pct")
            .orderBy(F.asc_nulls_last("on_time_pct"), "customer_state"))


def delivery_days_by_state(star: Star, min_orders: int = MIN_ORDERS) -> DataFrame:
    """State means against the national mean. The mean is rounded, the unrounded national mean taken off, and the
    difference rounded again."""
    timed = order_grain(star.fact_orders.filter("delivery_days IS NOT NULL"), "customer_id", "delivery_days")
    national = timed.agg(F.avg("delivery_days")).scalar()
    states = (kpis.with_state(timed, star.dim_customers).groupBy("customer_state")
              .agg(F.count("*").alias("delivered_orders"),
                   F.round(F.avg("delivery_days"), 1).alias("avg_delivery_days"))
              .filter(F.col("delivered_orders") >= min_orders).withColumn("natl_avg", national))
    return (states.withColumn("days_vs_natl_avg", F.round(F.col("avg_delivery_days") - F.col("natl_avg"), 1))
            .orderBy(F.desc("avg_delivery_days"), "customer_state"))


def review_distribution(star: Star) -> DataFrame:
    reviewed = order_grain(star.fact_orders.filter("review_score IS NOT NULL"), "review_score")
    scores = reviewed.groupBy("review_score").agg(F.count("*").alias("orders"))
    return scores.select("review_score", "orders", share(F.col("orders")).alias("pct")).orderBy("review_score")


def repeat_rate(star: Star) -> DataFrame:
    return kpis.repeat_rate(star, digits=3)


def revenue_by_buyer(star: Star) -> DataFrame:
    return kpis.revenue_by_buyer_type(star, "buyer_type", REPEAT, ONE_TIME)


def reports(star: Star, min_orders: int = MIN_ORDERS, n: int = TOP_N) -> dict[str, DataFrame]:
    """All exploratory reports by name; written with ``run_corpus`` or ``write_result``, they are a few rows each."""
    # Names of the stored reports.
    return {
        "01_monthly_revenue": kpis.revenue_by_month(star),
        "02_category_rank_top_bottom": category_extremes(star, n),
        "03a_ontime_overall": on_time_overall(star),
        "03b_ontime_by_state": on_time_by_state(star, min_orders),
        "04_delivery_days_by_state": delivery_days_by_state(star, min_orders),
        "05a_review_score_distribution": review_distribution(star),
        "05b_late_vs_ontime_reviews": kpis.reviews_by_punctuality(star),
        "06_repeat_purchase_rate": repeat_rate(star),
        "07_revenue_repeat_vs_onetime": revenue_by_buyer(star),
    }


def findings(made: dict[str, DataFrame]) -> DataFrame:
    """One row with the headline of every report. Pass reports read back from their files to avoid computing them again;
    each is reduced to one struct."""
    def headline(name: str, *columns: Column) -> Column:
        return made[name].agg(F.struct(*columns).alias("h")).scalar()

    def at_smallest(value: str, measure: Column, tie: str) -> Column:
        """The value at the smallest measure; ties go to the first in order."""
        return F.min_by(F.col(value), F.struct(measure, F.col(tie)))

    def of_group(flag: bool, column: str) -> Column:
        return F.max(F.when(F.col("is_on_time") == flag, F.col(column)))

    top = F.col("side").startswith("top")
    revenue, pct, days = F.col("revenue_brl"), F.col("on_time_pct"), F.col("avg_delivery_days")
    parts = {
        "m": headline("01_monthly_revenue", at_smallest("year_month", -revenue, "year_month").alias("peak_month"),
                      F.max("revenue_brl").alias("peak_month_brl")),
        "c": headline("02_category_rank_top_bottom", F.round(F.sum(F.when(top, revenue)), 2).alias("top_brl"),
                      F.round(F.sum(F.when(~top, revenue)), 2).alias("bottom_brl"),
                      F.min_by("category", "rank_desc").alias("top_category"),
                      F.max_by("category", "rank_desc").alias("last_category")),
        "o": headline("03a_ontime_overall", F.max("on_time_pct").alias("on_time_pct"),
                      F.max("on_time_orders").alias("on_time_orders"),
                      F.max("delivered_orders").alias("delivered_orders")),
        "s": headline("03b_ontime_by_state", at_smallest("customer_state", pct, "customer_state").alias("worst_state"),
                      F.min("on_time_pct").alias("worst_state_pct"),
                      F.max_by("customer_state", F.struct("on_time_pct", "customer_state")).alias("best_state"),
                      F.max("on_time_pct").alias("best_state_pct")),
        # The national mean is told as the slowest state's mean less its distance, both as shown.
        "d": headline("04_delivery_days_by_state",
                      at_smallest("customer_state", -days, "customer_state").alias("slowest_state"),
                      F.max("avg_delivery_days").alias("slowest_days"),
                      F.round(F.max("avg_delivery_days") - at_smallest("days_vs_natl_avg", -days, "customer_state"), 1)
                      .alias("national_days")),
        "r": headline("05b_late_vs_ontime_reviews", of_group(True, "avg_review_score").alias("on_time_score"),
                      of_group(False, "avg_review_score").alias("late_score"),
                      of_group(False, "pct_1star").alias("late_pct_1star"),
                      of_group(True, "pct_1star").alias("on_time_pct_1star")),
        "p": headline("06_repeat_purchase_rate", F.max("repeat_rate_pct").alias("repeat_rate_pct"),
                      F.max("repeat_customers").alias("repeat_customers"),
                      F.max("total_customers").alias("total_customers"),
                      F.max("avg_orders_per_customer").alias("avg_orders_per_customer")),
        "b": headline("07_revenue_repeat_vs_onetime",
                      F.max(F.when(F.col("buyer_type") == REPEAT, F.col("pct_of_revenue")))
                      .alias("repeat_pct_of_revenue")),
    }
    row = made["01_monthly_revenue"].sparkSession.range(1).select(*[c.alias(name) for name, c in parts.items()])
    return row.select(*[f"{name}.*" for name in parts])


# ---------------------------------------------------------------- derived figures


def excess_late_orders(by_state: DataFrame, overall: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Late orders a state would not have had at the overall on-time rate, for states below it, plus a total row.

    ``by_state`` and ``overall`` are the finished reports, so the rates are those shown to readers.
    """
    line = overall.agg(F.max("on_time_pct")).scalar()
    below = by_state.withColumn("line", line).filter(F.col("on_time_pct") < F.col("line"))
    if states is not None:
        below = below.filter(F.col("customer_state").isin(states))
    gap = F.round(F.col("delivered_orders") * (F.col("line") - F.col("on_time_pct")) / 100).cast("bigint")
    rows = below.select("customer_state", "delivered_orders", "on_time_pct", gap.alias("excess_late_orders"))
    total = rows.agg(F.sum("delivered_orders").alias("delivered_orders"),
                     F.sum("excess_late_orders").alias("excess_late_orders"))
    return rows.unionByName(total.select(F.lit("Total").alias("customer_state"), "delivered_orders",
                                         F.lit(None).cast("double").alias("on_time_pct"), "excess_late_orders"))


def one_star_shares(star: Star) -> DataFrame:
    """One-star reviews and the part given to late orders, over all reviewed and over delivered orders only."""
    reviewed = order_grain(star.fact_orders.filter("review_score IS NOT NULL"),
                           "is_delivered", "is_on_time", "review_score")
    one = F.col("review_score") == 1
    counts = reviewed.agg(count_where(one).alias("one_star_all"),
                          count_where(one & F.col("is_delivered")).alias("one_star_delivered"),
                          count_where(one & ~F.col("is_delivered")).alias("one_star_undelivered"),
                          count_where(one & F.col("is_delivered") & late()).alias("one_star_late"))
    return counts.select("*", percent(F.col("one_star_late"), F.col("one_star_all"), 1).alias("late_pct_of_all"),
                         percent(F.col("one_star_late"), F.col("one_star_delivered"), 1)
                         .alias("late_pct_of_delivered"))


def customer_value(star: Star) -> DataFrame:
    """Revenue per person for repeat and one-time buyers, and how many times larger the former is."""
    people = person_orders(star.fact_orders, star.dim_customers)
    repeat = F.col("n_orders") >= 2

    def total(condition, column):
        return F.sum(F.when(condition, column))

    sums = people.agg(count_where(repeat).alias("nr"), count_where(~repeat).alias("no"),
                      total(repeat, F.col("revenue")).alias("rr"), total(~repeat, F.col("revenue")).alias("ro"))
    per_repeat = F.try_divide(F.col("rr").cast("double"), F.col("nr").cast("double"))
    per_one = F.try_divide(F.col("ro").cast("double"), F.col("no").cast("double"))
    return sums.select(F.round(per_repeat, 2).alias("repeat_revenue_per_customer"),
                       F.round(per_one, 2).alias("one_time_revenue_per_customer"),
                       F.round(F.try_divide(per_repeat, per_one), 2).alias("ratio"))


def top_category_share(star: Star, n: int = TOP_N) -> DataFrame:
    cats = kpis.category_money(star).select("category", F.round("revenue", 2).alias("revenue"))
    total = cats.agg(F.sum("revenue")).scalar()
    top = cats.orderBy(F.desc("revenue"), "category").limit(n).withColumn("total", total)
    return top.agg(money(F.sum("revenue")).alias("top_revenue_brl"),
                   percent(F.sum("revenue"), F.max("total"), 1).alias("pct_of_revenue"))


def what_if_repeat(star: Star, points: float = 1.0) -> DataFrame:
    """Revenue added if ``points`` percent of all customers bought once more at the average order value."""
    orders = order_money(star.fact_orders, "customer_id")
    ids = star.dim_customers.select("customer_id", "customer_unique_id")
    people = (orders.join(ids, "customer_id", "left").groupBy("customer_unique_id")
              .agg(F.count("*").alias("n"), F.sum("order_revenue").alias("r")))
    sums = people.agg(F.count("customer_unique_id").alias("customers"), F.sum("n").alias("orders"),
                      F.sum("r").alias("revenue"))
    extra = F.lit(points / 100.0) * F.col("customers")
    value = F.try_divide(F.col("revenue").cast("double"), F.col("orders").cast("double"))
    return sums.select("customers", F.round(extra).cast("bigint").alias("extra_customers"),
                       F.round(value, 2).alias("avg_order_value"), F.round(extra * value, 2).alias("added_revenue_brl"))


def what_if_late_reviews(star: Star, avoided: float = 0.5) -> DataFrame:
    return one_star_shares(star).select("one_star_late",
                                        (F.col("one_star_late") * F.lit(avoided)).alias("one_stars_avoided"))
