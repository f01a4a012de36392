"""Small hand-written stars."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from orderlens.operators import star as build
from orderlens.schemas import RAW


def day(text):
    return datetime.strptime(text, "%Y-%m-%d")


def raw_tables(spark, orders, items, customers=None, reviews=(), payments=(), products=None, translation=None,
               sellers=None):
    """Raw frames from short tuples.

    orders: (order_id, customer_id, status, purchase, delivered, estimated); items: (order_id, item, product, price, freight)
    customers: (customer_id, unique_id, state); products: (product_id, category)
    """
    def frame(table, rows, columns):
        schema = [f for f in RAW[table].fields if f.name in columns]
        text = ", ".join(f"{c} {next(f.dataType.simpleString() for f in schema if f.name == c)}" for c in columns)
        made = spark.createDataFrame(list(rows), text)
        return made.select(*[F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in RAW[table].fields])

    customers = customers or [(o[1], o[1], "SP") for o in orders]
    products = products or sorted({(i[2], "c_" + i[2]) for i in items})
    translation = translation if translation is not None else sorted({(c, c.upper()) for _, c in products if c})
    sellers = sellers or [("s1", " SP ")]
    return {
        "orders": frame("orders", orders, ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                                           "order_delivered_customer_date", "order_estimated_delivery_date"]),
        "order_items": frame("order_items", [(o, n, p, "s1", Decimal(str(a)), Decimal(str(b)))
                                             for o, n, p, a, b in items],
                             ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]),
        "customers": frame("customers", customers, ["customer_id", "customer_unique_id", "customer_state"]),
        "products": frame("products", products, ["product_id", "product_category_name"]),
        "category_translation": frame("category_translation", translation,
                                      ["product_category_name", "product_category_name_english"]),
        "sellers": frame("sellers", sellers, ["seller_id", "seller_state"]),
        "order_reviews": frame("order_reviews", reviews, ["review_id", "order_id", "review_score",
                                                          "review_creation_date", "review_answer_timestamp"]),
        "order_payments": frame("order_payments", [(o, n, k, i, Decimal(str(v))) for o, n, k, i, v in payments],
                                ["order_id", "payment_sequential", "payment_type", "payment_installments",
                                 "payment_value"]),
    }


def make_star(spark, *args, **kwargs):
    return build.build_star(spark, raw_tables(spark, *args, **kwargs))


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def one(frame):
    return frame.collect()[0].asDict()
