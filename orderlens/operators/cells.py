"""The interactive report from mergeable cells: any filter, no scan of items.

An order bought items of one or more categories, and a filter on categories must count it once however many of them pass.
So an order's cell is keyed by the *list* of its categories, in order of their first item: an order passes if any of its list
does, and its category under the filter is the first that does. All other order facts a chart needs are in the key or add up.
Revenue adds up per category. Whether a buyer is a repeat buyer depends on the filter, but only for buyers with more than
one order at all: these orders are kept one by one, the others count as one buyer each.

* ``orders``: month, day, state, delivered, on time, score, categories, buyer kind -> orders, delivery days
* ``revenue``: month, day, state, category, buyer kind -> revenue
* ``repeaters``: person, month, day, state, category list with revenue, one row per order of a person with several

Cells of new months are added to the old ones by writing them beside them; a buyer who comes back moves from ``single`` to
``several``, so the months they bought in before are built anew. There are at most as many cells as orders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.measures import count_where, item_revenue, money, percent, share
from orderlens.operators.kpis import MIN_ORDERS
from orderlens.operators.report import LATE, OF_CUSTOMERS, OF_REVENUE, ON_TIME, ONE_TIME, REPEAT, TOP, Filters
from orderlens.session import scratch_path
from orderlens.sources.star import Star

#: Buyers: with one order, with several, unknown.
SINGLE, SEVERAL, UNKNOWN_BUYER = "single", "several", "unknown"
MONEY = "decimal(38,2)"


@dataclass(frozen=True)
class Cells:
    orders: DataFrame
    revenue: DataFrame
    repeaters: DataFrame


#: What tells orders apart, but for their buyer.
ORDER = ["order_id", "month", "day", "is_delivered", "is_on_time", "review_score", "delivery_days"]
BUYER = ["customer_unique_id", "customer_state"]


def build_cells(view: DataFrame) -> Cells:
    """Cells of the item view. Rows without state, category or purchase time drop out, as in ``filtered_items``."""
    return _cells(_listed(view.filter("customer_state IS NOT NULL"), [*ORDER, *BUYER]))


def build_star_cells(star: Star) -> Cells:
    """Cells of the star's item view, in which all items of an order have one customer id.

    Items lie together by order in the fact already and are listed there; only orders travel to their buyers. A customer
    that is there several times counts as often as in the view.
    """
    fact = star.fact_orders.select("order_id", "order_item_id", "customer_id", "product_id", "purchase_ts",
                                   item_revenue().alias("item_revenue"), "delivery_days", "is_delivered", "is_on_time",
                                   "review_score").withColumn("month", F.date_format("purchase_ts", "yyyy-MM"))
    names = star.dim_products.select("product_id", F.col("product_category_en").alias("category"))
    buyers = (star.dim_customers.filter("customer_state IS NOT NULL").groupBy("customer_id", *BUYER)
              .agg(F.count("*").alias("copies")))
    orders = _listed(fact.join(names, "product_id"), [*ORDER, "customer_id"]).join(buyers, "customer_id")
    return _cells(orders.withColumn("revenue", F.transform("revenue", lambda r: (r * F.col("copies")).cast(MONEY)))
                  .drop("customer_id", "copies"))


def _listed(items: DataFrame, order: list[str]) -> DataFrame:
    """A row per order with its categories, in order of their first item, and the revenue of each."""
    items = items.filter("category IS NOT NULL AND purchase_ts IS NOT NULL").withColumn("day", F.col("purchase_ts").cast("date"))
    per_category = items.groupBy(*order, "category").agg(F.min("order_item_id").alias("first"),
                                                         F.sum("item_revenue").cast(MONEY).alias("r"))
    listed = F.array_sort(F.collect_list(F.struct("first", "category", "r")))  # an order's categories
    return per_category.groupBy(*order).agg(listed.alias("l")).withColumns({
        "categories": F.transform("l", lambda e: e["category"]),
        "revenue": F.transform("l", lambda e: e["r"])}).drop("l")


def _cells(orders: DataFrame) -> Cells:
    orders = _written(orders, "cell-orders")
    several = (orders.filter("customer_unique_id IS NOT NULL").groupBy("customer_unique_id").agg(F.count("*").alias("n"))
               .filter("n > 1").select("customer_unique_id", F.lit(SEVERAL).alias("kind")))
    kinds = orders.join(several, "customer_unique_id", "left").withColumn("buyer", F.coalesce(
        "kind", F.when(F.col("customer_unique_id").isNull(), UNKNOWN_BUYER).otherwise(SINGLE))).drop("kind")
    kinds = _written(kinds, "cell-kinds")  # orders meet their buyers' kinds once, not for each of the three tables
    key = ["month", "day", "customer_state"]
    # Hardly any two orders share a list of categories, so they go to their month first and are counted there.
    counted = kinds.repartition("month").groupBy(*key, "is_delivered", "is_on_time", "review_score", "categories", "buyer").agg(
        F.count("*").alias("orders"), F.sum("delivery_days").alias("days"), F.count("delivery_days").alias("timed"))
    paid = kinds.select(*key, "buyer", F.explode(F.arrays_zip("categories", "revenue")).alias("e")).groupBy(
        *key, F.col("e.categories").alias("category"), "buyer").agg(F.sum("e.revenue").cast(MONEY).alias("revenue"))
    persons = kinds.filter(F.col("buyer") == SEVERAL).select("customer_unique_id", *key, "categories", "revenue")
    return Cells(counted, paid.repartition("month"), persons.repartition("month"))


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


TABLES = ("orders", "revenue", "repeaters")


def write_cells(cells: Cells, folder: str) -> None:
    """The three tables by month, so that a filter on dates never lists the others. Cells of months that are not there yet
    may be written to the same folder later. ``build_cells`` has brought the rows of a month together."""
    for name in TABLES:
        getattr(cells, name).write.mode("append").partitionBy("month").parquet(f"{folder}/{name}")


def read_cells(spark: SparkSession, folder: str) -> Cells:
    return Cells(*(spark.read.parquet(f"{folder}/{name}")
                   .withColumn("month", F.col("month").cast("string")) for name in TABLES))


def selected(cells: Cells, filters: Filters = Filters()) -> Cells:
    """The cells that pass. ``orders`` gets ``category``, the first of the list that passes; lists of ``repeaters`` are cut to
    what passes."""
    keep = F.lit(True)
    for bound, of_day, of_month in ((filters.date_from, "day >= '{}'", "month >= '{}'"),
                                    (filters.date_to, "day <= '{}'", "month <= '{}'")):
        if bound is not None:
            keep = keep & F.expr(of_day.format(bound.isoformat())) & F.expr(of_month.format(bound.strftime("%Y-%m")))
    if filters.states is not None:
        keep = keep & F.col("customer_state").isin(list(filters.states))

    def passes(category: Column) -> Column:
        return F.lit(True) if filters.categories is None else category.isin(list(filters.categories))

    orders = cells.orders.filter(keep).withColumn("category", F.get(F.filter("categories", passes), F.lit(0))).filter(
        "category IS NOT NULL")
    zipped = F.filter(F.arrays_zip("categories", "revenue"), lambda e: passes(e["categories"]))
    repeaters = cells.repeaters.filter(keep).withColumn("e", zipped).filter("size(e) > 0").withColumns(
        {"categories": F.col("e.categories"), "revenue": F.col("e.revenue")}).drop("e")
    return Cells(orders, cells.revenue.filter(keep & passes(F.col("category"))), repeaters)


def _people(cells: Cells) -> DataFrame:
    """(customer_unique_id, n, r) of buyers with several orders at all: orders and revenue in the selection."""
    spent = F.aggregate("revenue", F.lit(0).cast(MONEY), lambda a, b: (a + b).cast(MONEY))
    return cells.repeaters.groupBy("customer_unique_id").agg(F.count("*").alias("n"), F.sum(spent).alias("r"))


def _buyers(cells: Cells) -> DataFrame:
    """One row: buyers and revenue by their kind in the selection."""
    people = _people(cells).agg(
        F.count("*").alias("seen"), count_where(F.col("n") >= 2).alias("repeat_n"),
        F.coalesce(F.sum(F.when(F.col("n") >= 2, F.col("r"))), F.lit(0)).alias("repeat_r"))
    single = cells.orders.filter(F.col("buyer") == SINGLE).agg(F.coalesce(F.sum("orders"), F.lit(0))).scalar()
    known = cells.revenue.filter(F.col("buyer") != UNKNOWN_BUYER).agg(F.coalesce(F.sum("revenue"), F.lit(0))).scalar()
    return people.select("repeat_n", "repeat_r", (F.col("seen") + single).alias("n"), known.alias("r"))


def _when(condition: str, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(F.expr(condition), value)), F.lit(0))


def kpi_cards(cells: Cells) -> DataFrame:
    orders = F.col("orders")
    totals = cells.orders.agg(_when("is_delivered AND is_on_time", orders).alias("on_time"),
                              _when("is_delivered AND is_on_time IS NOT NULL", orders).alias("judged"),
                              _when("review_score IS NOT NULL", F.col("review_score") * orders).alias("score"),
                              _when("review_score IS NOT NULL", orders).alias("scored"))
    buyers = _buyers(cells).select(F.struct("repeat_n", "n").alias("b")).scalar()
    revenue = cells.revenue.agg(F.sum("revenue")).scalar()
    score = F.try_divide(F.col("score").cast("double"), F.col("scored").cast("double"))
    return totals.select(F.coalesce(money(revenue), F.lit(0.0)).alias("revenue"),
                         percent(F.col("on_time"), F.col("judged"), 1).alias("on_time_pct"),
                         F.round(score, 2).alias("avg_score"), percent(buyers["repeat_n"], buyers["n"], 1).alias("repeat_rate"))


def monthly_revenue(cells: Cells) -> DataFrame:
    counts = cells.orders.groupBy("month").agg(F.sum("orders").alias("orders"))
    sums = cells.revenue.groupBy("month").agg(money(F.sum("revenue")).alias("revenue_brl"))
    return sums.join(counts, "month").select("month", "revenue_brl", "orders").orderBy("month")


def _top_revenue(cells: Cells, key: str, n: int) -> DataFrame:
    sums = cells.revenue.groupBy(key).agg(F.sum("revenue").alias("r")).orderBy(F.desc("r"), key).limit(n)
    return sums.select(key, money(F.col("r")).alias("item_revenue"))


def top_states(cells: Cells, n: int = TOP) -> DataFrame:
    return _top_revenue(cells, "customer_state", n)


def top_categories(cells: Cells, n: int = TOP) -> DataFrame:
    return _top_revenue(cells, "category", n)


def delivery_days_by_state(cells: Cells, min_orders: int = MIN_ORDERS) -> DataFrame:
    mean = F.try_divide(F.sum("days"), F.sum("timed").cast("double"))
    national = cells.orders.agg(mean).scalar()
    return (cells.orders.groupBy("customer_state").agg(F.round(mean, 1).alias("avg_days"), F.sum("timed").alias("n"))
            .filter((F.col("n") >= min_orders) & (F.col("n") > 0)).withColumn("natl_avg", F.round(national, 1))
            .orderBy("avg_days", "customer_state"))


def on_time_by_month(cells: Cells) -> DataFrame:
    orders = F.col("orders")
    months = cells.orders.filter("is_delivered").groupBy("month").agg(
        _when("is_on_time", orders).alias("on_time"), _when("is_on_time IS NOT NULL", orders).alias("judged"),
        F.sum(orders).alias("n"))
    overall = months.agg(percent(F.sum("on_time"), F.sum("judged"), 1)).scalar()
    return (months.select("month", percent(F.col("on_time"), F.col("judged"), 1).alias("on_time_pct"), "n",
                          overall.alias("overall")).orderBy("month"))


def late_by_category(cells: Cells, n: int = TOP) -> DataFrame:
    late = cells.orders.filter("is_delivered AND NOT is_on_time").groupBy("category").agg(F.sum("orders").alias("late_orders"))
    return late.orderBy(F.desc("late_orders"), "category").limit(n)


def score_distribution(cells: Cells) -> DataFrame:
    scores = cells.orders.filter("review_score IS NOT NULL").groupBy("review_score").agg(F.sum("orders").alias("orders"))
    return scores.select("review_score", "orders", share(F.col("orders")).alias("pct")).orderBy("review_score")


def _mean_score() -> Column:
    return F.sum((F.col("review_score") * F.col("orders")).cast("double")) / F.sum("orders").cast("double")


def scores_by_punctuality(cells: Cells) -> DataFrame:
    judged = cells.orders.filter("review_score IS NOT NULL AND is_on_time IS NOT NULL")
    return (judged.groupBy(F.when(F.col("is_on_time"), ON_TIME).otherwise(LATE).alias("label"))
            .agg(F.round(_mean_score(), 2).alias("avg_score"), F.sum("orders").alias("n")).orderBy("label"))


def worst_reviewed_categories(cells: Cells, min_orders: int = MIN_ORDERS, n: int = TOP) -> DataFrame:
    cats = (cells.orders.filter("review_score IS NOT NULL").groupBy("category")
            .agg(_mean_score().alias("score"), F.sum("orders").alias("n"))
            .filter(F.col("n") >= min_orders).orderBy("score", "category").limit(n))
    return cats.select("category", F.round("score", 2).alias("avg_score"), "n").orderBy(F.desc("avg_score"), "category")


def buyer_shares(cells: Cells) -> DataFrame:
    sums = _buyers(cells).withColumns({"one_n": F.col("n") - F.col("repeat_n"), "one_r": F.col("r") - F.col("repeat_r")})

    def row(kind: str, label: str, part: str, whole: str) -> Column:
        return F.struct(F.lit(kind).alias("buyer_type"), F.lit(label).alias("share_type"),
                        percent(F.col(part), F.col(whole), 1).alias("pct"))

    return sums.select(F.inline(F.array(row(ONE_TIME, OF_CUSTOMERS, "one_n", "n"), row(ONE_TIME, OF_REVENUE, "one_r", "r"),
                                        row(REPEAT, OF_CUSTOMERS, "repeat_n", "n"), row(REPEAT, OF_REVENUE, "repeat_r", "r"))))


def orders_per_customer(cells: Cells, cap: int = 5) -> DataFrame:
    several = _people(cells).groupBy(F.least("n", F.lit(cap)).alias("k")).agg(F.count("*").alias("customers"))
    single = cells.orders.filter(F.col("buyer") == SINGLE).groupBy(F.lit(1).cast("bigint").alias("k")).agg(
        F.sum("orders").alias("customers"))
    label = F.when(F.col("k") == cap, F.lit(f"{cap}+")).otherwise(F.col("k").cast("string"))
    return (several.unionByName(single).groupBy("k").agg(F.sum("customers").alias("customers")).orderBy("k")
            .select(label.alias("orders"), "customers"))


def filter_domains(cells: Cells) -> DataFrame:
    """(domain, value): first and last purchase date, all states and all categories."""
    days = cells.revenue.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(F.inline(F.array(
        F.struct(F.lit("date_min").alias("domain"), F.col("lo").cast("string").alias("value")),
        F.struct(F.lit("date_max").alias("domain"), F.col("hi").cast("string").alias("value")))))
    parts = [cells.revenue.select(F.lit(name).alias("domain"), F.col(column).alias("value")).distinct()
             for name, column in (("state", "customer_state"), ("category", "category"))]
    return days.filter("value IS NOT NULL").unionByName(parts[0]).unionByName(parts[1]).orderBy("domain", "value")


#: The charts under the names of their functions in ``report``, which give the same rows from items.
CHARTS = {f.__name__: f for f in (
    kpi_cards, monthly_revenue, top_states, top_categories, delivery_days_by_state, on_time_by_month, late_by_category,
    score_distribution, scores_by_punctuality, worst_reviewed_categories, buyer_shares, orders_per_customer, filter_domains)}
