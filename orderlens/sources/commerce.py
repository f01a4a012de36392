"""Adapter: the benchmark's order, line item and party tables seen as a star and as raw files.

Deliveries, reviews and payments do not exist in those tables. They are derived by integer arithmetic from keys, the same
way for every row, so that any engine gets the same values:

* a person owns every tenth order of a customer key, other orders have a buyer of their own;
* status ``P`` means not delivered; delivery days are whole quarter days between 1 and 40.75;
* the promise is 10 days plus 4 per priority step; every twentieth order has no review, late orders score 1-3;
* part names starting with ``old`` have no category, every fiftieth part has no weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.star import calendar, date_key, newest_reviews, review_dimension
from orderlens.schemas import MONEY
from orderlens.session import scratch_path, shuffles_removed
from orderlens.sources.star import Frames, Star

# Schemas of the test tables that are read; given, so that no job is started to infer them.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def calendar_days(spark: SparkSession, folder: str) -> tuple[Column, Column]:
    """First and last day of the years in which orders were placed, as scalars of the plan: purchases outside a calendar
    would drop out of monthly reports."""
    date = F.col("o_orderdate")
    ends = table(spark, folder, "orders").agg(F.struct(F.year(F.min(date)).alias("lo"), F.year(F.max(date)).alias("hi"))).scalar()
    return F.make_date(ends["lo"], F.lit(1), F.lit(1)), F.make_date(ends["hi"], F.lit(12), F.lit(31))


def _plus_hours(ts: str, hours: Column) -> Column:
    return F.col(ts) + F.make_dt_interval(F.lit(0), hours.cast("int"))


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with every order-level column of the fact."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    promise = F.lit(10) + F.lit(4) * F.substring("o_orderpriority", 1, 1).cast("int")
    quarters = F.lit(4) * (F.lit(1) + (key * 7 + cust * 3) % 40) + key % 4
    base = table(spark, folder, "orders").select(
        key.alias("order_id"), key.alias("customer_id"), cust.alias("o_custkey"),
        F.when(key % 10 == 0, F.concat(F.lit("P"), cust.cast("string")))
         .otherwise(F.concat(F.lit("O"), key.cast("string"))).alias("customer_unique_id"),
        F.col("o_orderstatus").alias("order_status"),
        _plus_hours("o_orderdate", key % 24).alias("purchase_ts"),
        (F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100 + F.day("o_orderdate")).alias("purchase_date_key"),
        promise.alias("_promise"),
        F.when(F.col("o_orderstatus") != "P", quarters).alias("_quarters"))
    late = F.col("_quarters") > F.col("_promise") * 4
    score = (F.col("order_id") + F.col("o_custkey")) % 3
    delivered = F.col("_quarters").isNotNull()
    return base.withColumns({
        "delivery_days": F.col("_quarters").cast("double") / 4,
        "is_delivered": delivered,
        "is_on_time": F.col("_quarters") <= F.col("_promise") * 4,
        "review_score": F.when((F.col("order_id") * 31) % 20 == 0, F.lit(None))
        .when(late, score + 1).otherwise(score + 3).cast("int"),
        "approved_ts": _plus_hours("purchase_ts", F.lit(1)),
        "carrier_delivery_ts": F.when(delivered, _plus_hours("purchase_ts", F.lit(24))),
        "customer_delivery_ts": _plus_hours("purchase_ts", F.col("_quarters") * 6),
        "estimated_delivery_ts": _plus_hours("purchase_ts", F.col("_promise") * 24),
    })


def item_key() -> Column:
    """A key of an item within its order. The line number alone is not unique in these tables."""
    return F.concat_ws("-", F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                       F.round(F.col("l_extendedprice") * 100).cast("bigint"), date_key(F.col("l_shipdate")))


FACT = ["order_id", "order_item_id", "customer_id", "product_id", "seller_id", "purchase_date_key", "order_status",
        "purchase_ts", "approved_ts", "carrier_delivery_ts", "customer_delivery_ts", "estimated_delivery_ts",
        "price", "freight_value", "delivery_days", "is_delivered", "is_on_time", "review_score"]


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), item_key().alias("order_item_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"), F.col("l_quantity").cast(MONEY).alias("freight_value"))


def _buyers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: its customer id, the person, segment and nation."""
    ids = order_facts(spark, folder).select("customer_id", "customer_unique_id", "o_custkey")
    places = table(spark, folder, "customer").join(table(spark, folder, "nation"),
                                                   F.col("c_nationkey") == F.col("n_nationkey"))
    return ids.join(places, F.col("o_custkey") == F.col("c_custkey"))


def _sellers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").join(table(spark, folder, "nation"),
                                                 F.col("s_nationkey") == F.col("n_nationkey"))


def _sizes() -> list[Column]:
    size = F.col("p_size")
    return [F.length("p_name").alias("name_length"), F.length("p_type").alias("description_length"),
            (size % 5).alias("photos_qty"),
            F.when(F.col("p_partkey") % 50 != 0, (size * 100).cast("double")).alias("product_weight_g"),
            size.cast("double").alias("length_cm"), (size % 7 + 1).cast("double").alias("height_cm"),
            (size % 11 + 1).cast("double").alias("width_cm")]


def star(spark: SparkSession, folder: str) -> Star:
    """The star, as lazy frames: a report reads only the tables and columns it uses."""
    no_zip = F.lit(None).cast("int")
    return Star({
        "dim_customers": lambda: _buyers(spark, folder).select(
            "customer_id", "customer_unique_id", no_zip.alias("customer_zip_code"),
            F.col("c_mktsegment").alias("customer_city"), F.col("n_name").alias("customer_state")),
        "dim_products": lambda: table(spark, folder, "part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_category_pt"),
            F.when(F.col("p_name").like("old %"), "unknown").otherwise(F.col("p_name")).alias("product_category_en"),
            *_sizes(), F.lit(None).cast("array<float>").alias("embedding")),
        "dim_sellers": lambda: _sellers(spark, folder).select(
            F.col("s_suppkey").alias("seller_id"), no_zip.alias("seller_zip_code"),
            F.col("s_name").alias("seller_city"), F.col("n_name").alias("seller_state")),
        "dim_reviews": lambda: _reviews(order_facts(spark, folder)),
        "dim_payments": lambda: _payments(spark, folder),
        "dim_date": lambda: calendar(spark, *calendar_days(spark, folder)),
        "fact_orders": lambda: _items(spark, folder).join(order_facts(spark, folder), "order_id").select(*FACT),
    })


def stored_star(spark: SparkSession, folder: str) -> Star:
    """The same star with its fact written once: many reports on it read the items from there instead of joining them
    each time."""
    path, lazy = scratch_path(spark, "fact"), star(spark, folder)
    with shuffles_removed(spark):
        lazy.fact_orders.write.parquet(path)
    return lazy.with_fact(spark.read.schema(lazy.fact_orders.schema).parquet(path))


def _payments(spark: SparkSession, folder: str) -> DataFrame:
    """A card payment for every order and a voucher for every seventh: one scan, at most two rows per order."""
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    card = F.struct(F.lit(1).alias("payment_sequential"), F.col("o_orderpriority").alias("payment_type"),
                    (key % 10 + 1).cast("int").alias("payment_installments"),
                    F.col("o_totalprice").cast(MONEY).alias("payment_value"))
    voucher = F.struct(F.lit(2).alias("payment_sequential"), F.lit("voucher").alias("payment_type"),
                       F.lit(1).alias("payment_installments"), (key % 50 + 10).cast(MONEY).alias("payment_value"))
    rows = F.when(key % 7 == 0, F.array(card, voucher)).otherwise(F.array(card))
    return orders.select(key.alias("order_id"), F.explode(rows).alias("p")).select("order_id", "p.*")


def _review_rows(orders: DataFrame) -> DataFrame:
    """Raw reviews, with repeated review ids (some without an answer time) and second, earlier reviews of an order."""
    order, score = F.col("order_id"), F.col("review_score")

    def row(review_id: Column, stars: Column, created: int, answered: Column) -> Column:
        return F.struct(review_id.alias("review_id"), stars.cast("int").alias("review_score"),
                        _plus_hours("purchase_ts", F.lit(created * 24)).alias("created"), answered.alias("answered"))

    def after(days: int) -> Column:
        return _plus_hours("purchase_ts", F.lit(days * 24))

    none = F.array().cast("array<struct<review_id:bigint,review_score:int,created:timestamp_ntz,answered:timestamp_ntz>>")
    rows = F.concat(
        F.when(score.isNotNull(), F.array(row(order, score, 20, F.when(order % 33 != 0, after(22))))).otherwise(none),
        F.when(score.isNotNull() & (order % 13 == 0), F.array(row(order, 6 - score, 25, after(30)))).otherwise(none),
        F.when(order % 17 == 0, F.array(row(order + 1000000000, F.lit(1), 10, after(12)))).otherwise(none))
    return orders.select("order_id", F.explode(rows).alias("r")).select("order_id", "r.*")


def _reviews(orders: DataFrame) -> DataFrame:
    parsed = _review_rows(orders).select(
        "review_id", "order_id", "review_score", F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment"), F.col("created").alias("review_creation_ts"),
        F.col("answered").alias("review_answer_ts"))
    return review_dimension(newest_reviews(parsed))


def _places(spark: SparkSession, folder: str) -> DataFrame:
    """A place for every customer; every ninth has no position."""
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    known = key % 9 != 0
    return rows.select((key % 1000).cast("int").alias("geolocation_zip_code_prefix"),
                       F.when(known, (key % 90).cast("double")).alias("geolocation_lat"),
                       F.when(known, (-(key % 180)).cast("double")).alias("geolocation_lng"),
                       F.col("c_mktsegment").alias("geolocation_city"), F.col("n_name").alias("geolocation_state"))


def raw_frames(spark: SparkSession, folder: str) -> Frames:
    """The same data shaped like the raw files: text timestamps (some unreadable), untrimmed states, untranslated names."""
    def text(column: str) -> Column:
        return F.col(column).cast("string")  # whole seconds; formatting would go through the session's time zone

    padded = F.concat(F.lit(" "), F.col("n_name"), F.lit("  "))
    no_zip, no_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    raw_sizes = ["product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
                 "product_length_cm", "product_height_cm", "product_width_cm"]
    name = F.col("product_category_name")
    return Frames({
        "customers": lambda: _buyers(spark, folder).select(
            "customer_id", "customer_unique_id", no_zip.alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"), padded.alias("customer_state")),
        "sellers": lambda: _sellers(spark, folder).select(
            F.col("s_suppkey").alias("seller_id"), no_zip.alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"), padded.alias("seller_state")),
        "products": lambda: table(spark, folder, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(~F.col("p_name").like("new %"), F.col("p_name")).alias("product_category_name"),
            *[size.alias(raw) for size, raw in zip(_sizes(), raw_sizes)]),
        "category_translation": lambda: table(spark, folder, "part").select(
            F.col("p_name").alias("product_category_name")).distinct().filter(~name.like("old %")).select(
            name, F.upper(name).alias("product_category_name_english")),
        "orders": lambda: order_facts(spark, folder).select(
            "order_id", "customer_id", "order_status", text("purchase_ts").alias("order_purchase_timestamp"),
            F.when(F.col("order_id") % 50 == 0, "garbage").otherwise(text("approved_ts")).alias("order_approved_at"),
            text("carrier_delivery_ts").alias("order_delivered_carrier_date"),
            text("customer_delivery_ts").alias("order_delivered_customer_date"),
            text("estimated_delivery_ts").alias("order_estimated_delivery_date")),
        "order_items": lambda: _items(spark, folder),
        "order_reviews": lambda: _review_rows(order_facts(spark, folder)).select(
            "review_id", "order_id", "review_score", no_text.alias("review_comment_title"),
            no_text.alias("review_comment_message"), text("created").alias("review_creation_date"),
            text("answered").alias("review_answer_timestamp")),
        "order_payments": lambda: _payments(spark, folder),
        "geolocation": lambda: _places(spark, folder),
    })
