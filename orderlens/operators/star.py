"""Raw tables to star schema: cleaning, delivery arithmetic, review selection, fact build, calendar."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.star import Star

UNKNOWN = "unknown"


def stripped(text: str) -> Column:
    return F.trim(F.col(text), F.lit(" \t\r\n\f\x0b"))


def lenient_timestamp(text: Column) -> Column:
    """Text to timestamp; NULL for text that is not a timestamp."""
    return text.try_cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Fractional days; NULL when either end is."""
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(86400000000.0)


def date_key(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)


def calendar(spark: SparkSession, first: str | Column, last: str | Column) -> DataFrame:
    """One row per day, both ends included; Monday is day 1. The ends are dates, or scalars of the plan; without an end
    there is no day."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d"))
    day, weekday = F.col("d"), F.weekday("d")
    return days.select(
        date_key(day).alias("date_key"), day.alias("full_date"), F.year(day).alias("year"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.quarter(day).alias("quarter"),
        (weekday + 1).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 5).alias("is_weekend"), F.date_format(day, "yyyy-MM").alias("year_month"))


def customers(raw: DataFrame) -> DataFrame:
    return raw.select("customer_id", "customer_unique_id",
                      F.col("customer_zip_code_prefix").alias("customer_zip_code"), "customer_city",
                      stripped("customer_state").alias("customer_state"))


def sellers(raw: DataFrame) -> DataFrame:
    return raw.select("seller_id", F.col("seller_zip_code_prefix").alias("seller_zip_code"), "seller_city",
                      stripped("seller_state").alias("seller_state"))


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Translated catalogue. A missing name is unknown in both languages; a name without translation keeps its own."""
    names = translation.select("product_category_name", "product_category_name_english")
    return raw.join(names, "product_category_name", "left").select(
        "product_id",
        F.coalesce("product_category_name", F.lit(UNKNOWN)).alias("product_category_pt"),
        F.coalesce("product_category_name_english", F.lit(UNKNOWN)).alias("product_category_en"),
        F.col("product_name_lenght").alias("name_length"),
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_photos_qty").alias("photos_qty"), "product_weight_g",
        F.col("product_length_cm").alias("length_cm"), F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"))


def payments(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")


def parsed_reviews(raw: DataFrame) -> DataFrame:
    return raw.select("review_id", "order_id", "review_score", "review_comment_title",
                      F.col("review_comment_message").alias("review_comment"),
                      lenient_timestamp(F.col("review_creation_date")).alias("review_creation_ts"),
                      lenient_timestamp(F.col("review_answer_timestamp")).alias("review_answer_ts"))


def newest_reviews(parsed: DataFrame) -> DataFrame:
    """One row per ``review_id``: the newest answer, where a missing answer time counts as newest.

    An aggregation, so copies of one review are reduced before the shuffle. Ties fall to the larger remaining columns.
    """
    order = [F.col("review_answer_ts").isNull().alias("_open"), F.col("review_answer_ts"),
             F.col("review_creation_ts"), F.col("order_id"), F.col("review_score"),
             F.col("review_comment_title"), F.col("review_comment")]
    newest = parsed.groupBy("review_id").agg(F.max(F.struct(*order)).alias("r"))
    return newest.select("review_id", "r.order_id", "r.review_score", "r.review_comment_title", "r.review_comment",
                         "r.review_creation_ts", "r.review_answer_ts")


def review_dimension(newest: DataFrame) -> DataFrame:
    return newest.select("review_id", "order_id", "review_score", "review_comment_title", "review_comment",
                         F.col("review_creation_ts").cast("date").alias("review_creation_date"), "review_answer_ts")


def first_review_scores(newest: DataFrame) -> DataFrame:
    """Score of the earliest review of every order; undated reviews come last, ties fall to answer time, then id."""
    order = F.struct(F.col("review_creation_ts").isNull().alias("_undated"), F.col("review_creation_ts"),
                     F.col("review_answer_ts").isNull().alias("_open"), F.col("review_answer_ts"),
                     F.col("review_id"), F.col("review_score"))
    return (newest.groupBy("order_id").agg(F.min(order).alias("r"))
            .select("order_id", F.col("r.review_score").alias("review_score")))


def enriched_orders(raw: DataFrame, newest: DataFrame) -> DataFrame:
    """Orders with readable timestamps, delivery arithmetic and the first review's score.

    Delivery is judged by the delivery time, not by the status. Undelivered orders have no ``is_on_time``; a delivered
    order without a promise is late.
    """
    stamps = {
        "purchase_ts": "order_purchase_timestamp",
        "approved_ts": "order_approved_at",
        "carrier_delivery_ts": "order_delivered_carrier_date",
        "customer_delivery_ts": "order_delivered_customer_date",
        "estimated_delivery_ts": "order_estimated_delivery_date",
    }
    bought, arrived, promised = F.col("purchase_ts"), F.col("customer_delivery_ts"), F.col("estimated_delivery_ts")
    parsed = raw.select("order_id", "customer_id", "order_status",
                        *[lenient_timestamp(F.col(old)).alias(new) for new, old in stamps.items()])
    return (parsed.withColumns({
        "purchase_date_key": date_key(bought),
        "delivery_days": days_between(bought, arrived),
        "is_delivered": arrived.isNotNull(),
        "is_on_time": F.when(arrived.isNotNull(), F.coalesce(arrived <= promised, F.lit(False))),
    })
            .join(first_review_scores(newest), "order_id", "left"))


def fact_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order item; items without an order drop out. Both sides meet on ``order_id``."""
    return items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value").join(
        orders, "order_id").select(
        "order_id", "order_item_id", "customer_id", "product_id", "seller_id", "purchase_date_key", "order_status",
        "purchase_ts", "approved_ts", "carrier_delivery_ts", "customer_delivery_ts", "estimated_delivery_ts",
        "price", "freight_value", "delivery_days", "is_delivered", "is_on_time", "review_score")


def build_star(spark: SparkSession, raw: Mapping[str, DataFrame], first_day: str | Column = "2016-01-01",
               last_day: str | Column = "2020-12-31") -> Star:
    """The whole star from the raw frames, as lazy plans."""
    def newest() -> DataFrame:
        return newest_reviews(parsed_reviews(raw["order_reviews"]))

    return Star({
        "dim_customers": lambda: customers(raw["customers"]),
        "dim_products": lambda: products(raw["products"], raw["category_translation"]),
        "dim_sellers": lambda: sellers(raw["sellers"]),
        "dim_reviews": lambda: review_dimension(newest()),
        "dim_payments": lambda: payments(raw["order_payments"]),
        "dim_date": lambda: calendar(spark, first_day, last_day),
        "fact_orders": lambda: fact_orders(raw["order_items"], enriched_orders(raw["orders"], newest())),
    })
