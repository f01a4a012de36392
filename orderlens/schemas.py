"""Explicit schemas of the raw files and of the star; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
_STR, _INT, _DBL, _BOOL = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_TS, _DATE = T.TimestampNTZType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names of the raw files (order and spelling are those of the published files, typos included).
RAW = {
    "customers": _schema(customer_id=_STR, customer_unique_id=_STR, customer_zip_code_prefix=_INT, customer_city=_STR,
                         customer_state=_STR),
    "products": _schema(product_id=_STR, product_category_name=_STR, product_name_lenght=_INT,
                        product_description_lenght=_INT, product_photos_qty=_INT, product_weight_g=_DBL,
                        product_length_cm=_DBL, product_height_cm=_DBL, product_width_cm=_DBL),
    "sellers": _schema(seller_id=_STR, seller_zip_code_prefix=_INT, seller_city=_STR, seller_state=_STR),
    "orders": _schema(order_id=_STR, customer_id=_STR, order_status=_STR, order_purchase_timestamp=_STR,
                      order_approved_at=_STR, order_delivered_carrier_date=_STR, order_delivered_customer_date=_STR,
                      order_estimated_delivery_date=_STR),
    "order_items": _schema(order_id=_STR, order_item_id=_INT, product_id=_STR, seller_id=_STR,
                           shipping_limit_date=_STR, price=MONEY, freight_value=MONEY),
    "order_reviews": _schema(review_id=_STR, order_id=_STR, review_score=_INT, review_comment_title=_STR,
                             review_comment_message=_STR, review_creation_date=_STR, review_answer_timestamp=_STR),
    "order_payments": _schema(order_id=_STR, payment_sequential=_INT, payment_type=_STR, payment_installments=_INT,
                              payment_value=MONEY),
    "category_translation": _schema(product_category_name=_STR, product_category_name_english=_STR),
    "geolocation": _schema(geolocation_zip_code_prefix=_INT, geolocation_lat=_DBL, geolocation_lng=_DBL,
                           geolocation_city=_STR, geolocation_state=_STR),
}

# Column names of the star.
STAR = {
    "dim_customers": _schema(customer_id=_STR, customer_unique_id=_STR, customer_zip_code=_INT, customer_city=_STR,
                             customer_state=_STR),
    "dim_products": _schema(product_id=_STR, product_category_pt=_STR, product_category_en=_STR, name_length=_INT,
                            description_length=_INT, photos_qty=_INT, product_weight_g=_DBL, length_cm=_DBL,
                            height_cm=_DBL, width_cm=_DBL, embedding=T.ArrayType(T.FloatType())),
    "dim_sellers": _schema(seller_id=_STR, seller_zip_code=_INT, seller_city=_STR, seller_state=_STR),
    "dim_reviews": _schema(review_id=_STR, order_id=_STR, review_score=_INT, review_comment_title=_STR,
                           review_comment=_STR, review_creation_date=_DATE, review_answer_ts=_TS),
    "dim_payments": _schema(order_id=_STR, payment_sequential=_INT, payment_type=_STR, payment_installments=_INT,
                            payment_value=MONEY),
    "dim_date": _schema(date_key=_INT, full_date=_DATE, year=_INT, month=_INT, month_name=_STR, quarter=_INT,
                        day_of_week=_INT, day_name=_STR, is_weekend=_BOOL, year_month=_STR),
    "fact_orders": _schema(order_id=_STR, order_item_id=_INT, customer_id=_STR, product_id=_STR, seller_id=_STR,
                           purchase_date_key=_INT, order_status=_STR, purchase_ts=_TS, approved_ts=_TS,
                           carrier_delivery_ts=_TS, customer_delivery_ts=_TS, estimated_delivery_ts=_TS,
                           price=MONEY, freight_value=MONEY, delivery_days=_DBL, is_delivered=_BOOL,
                           is_on_time=_BOOL, review_score=_INT),
}

STAR_KEYS = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_reviews": ["review_id"],
    "dim_payments": ["order_id", "payment_sequential"],
    "dim_date": ["date_key"],
    "fact_orders": ["order_id", "order_item_id"],
}
