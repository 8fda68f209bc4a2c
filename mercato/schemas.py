"""Schemas of the nine source tables, the messages and the read models, and the domains their columns must keep to."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# Column names and types of the source tables, spelt as the data set spells them.
TABLES: dict[str, T.StructType] = {
    "customers": _table(
        ("customer_id", _S),
        ("customer_unique_id", _S),
        ("customer_zip_code_prefix", _S),
        ("customer_city", _S),
        ("customer_state", _S),
    ),
    "geolocation": _table(
        ("geolocation_zip_code_prefix", _S),
        ("geolocation_lat", _D),
        ("geolocation_lng", _D),
        ("geolocation_city", _S),
        ("geolocation_state", _S),
    ),
    "orders": _table(
        ("order_id", _S),
        ("customer_id", _S),
        ("order_status", _S),
        ("order_purchase_timestamp", _TS),
        ("order_approved_at", _TS),
        ("order_delivered_carrier_date", _TS),
        ("order_delivered_customer_date", _TS),
        ("order_estimated_delivery_date", _TS),
    ),
    "order_items": _table(
        ("order_id", _S),
        ("order_item_id", _I),
        ("product_id", _S),
        ("seller_id", _S),
        ("shipping_limit_date", _TS),
        ("price", MONEY),
        ("freight_value", MONEY),
    ),
    "order_payments": _table(
        ("order_id", _S),
        ("payment_sequential", _I),
        ("payment_type", _S),
        ("payment_installments", _I),
        ("payment_value", MONEY),
    ),
    "order_reviews": _table(
        ("review_id", _S),
        ("order_id", _S),
        ("review_score", _I),
        ("review_comment_title", _S),
        ("review_comment_message", _S),
        ("review_creation_date", _TS),
        ("review_answer_timestamp", _TS),
    ),
    "products": _table(
        ("product_id", _S),
        ("product_category_name", _S),
        ("product_name_lenght", _I),
        ("product_description_lenght", _I),
        ("product_photos_qty", _I),
        ("product_weight_g", _I),
        ("product_length_cm", _I),
        ("product_height_cm", _I),
        ("product_width_cm", _I),
    ),
    "sellers": _table(
        ("seller_id", _S),
        ("seller_zip_code_prefix", _S),
        ("seller_city", _S),
        ("seller_state", _S),
    ),
    "product_category_name_translation": _table(
        ("product_category_name", _S),
        ("product_category_name_english", _S),
    ),
}

# Allowed order states and payment kinds.
ORDER_STATUSES = [
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "unavailable",
    "canceled",
]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]

# Key columns per table (geolocation has many rows per zip prefix and no key).
KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "product_category_name_translation": ["product_category_name"],
}

# Fixed values: (child table, parent table, column) of every foreign key.
FOREIGN_KEYS = [
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"),
    ("order_payments", "orders", "order_id"),
    ("order_reviews", "orders", "order_id"),
    ("products", "product_category_name_translation", "product_category_name"),
]

# Longest allowed string per column.
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "customers": {
        "customer_id": 50,
        "customer_unique_id": 50,
        "customer_zip_code_prefix": 5,
        "customer_city": 100,
        "customer_state": 2,
    },
    "geolocation": {
        "geolocation_zip_code_prefix": 5,
        "geolocation_city": 100,
        "geolocation_state": 2,
    },
    "orders": {"order_id": 50, "order_status": 20},
    "order_payments": {"payment_type": 20},
    "order_reviews": {"review_id": 50, "review_comment_title": 255},
    "products": {"product_id": 50, "product_category_name": 100},
    "sellers": {"seller_id": 50, "seller_zip_code_prefix": 5, "seller_city": 100, "seller_state": 2},
    "product_category_name_translation": {
        "product_category_name": 100,
        "product_category_name_english": 100,
    },
}

# Silver spelling of the two misspelt bronze columns.
SILVER_NAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

ROW_IMAGE = T.MapType(_S, _S)
CHANGE_ENVELOPE = _table(
    ("payload", _table(("before", ROW_IMAGE), ("after", ROW_IMAGE), ("op", _S), ("ts_ms", _L))),
)
ORDER_EVENT = _table(
    ("eventId", _S),
    ("eventType", _S),
    ("orderId", _S),
    ("customerId", _S),
    ("orderStatus", _S),
    ("eventTimestamp", T.TimestampType()),
    ("payload", ROW_IMAGE),
)
STREAM_ORDER = _table(
    ("event_time", T.TimestampType()),
    ("category", _S),
    ("customer_id", _S),
    ("order_id", _S),
    ("price", _D),
)

ANALYTICS_ITEM = _table(
    ("productId", _S),
    ("categoryName", _S),
    ("categoryNameEnglish", _S),
    ("sellerId", _S),
    ("price", MONEY),
    ("freightValue", MONEY),
)
READ_MODELS: dict[str, T.StructType] = {
    "order_analytics": _table(
        ("orderId", _S),
        ("customerId", _S),
        ("customerState", _S),
        ("customerCity", _S),
        ("orderStatus", _S),
        ("purchaseTimestamp", _TS),
        ("deliveredDate", _TS),
        ("estimatedDeliveryDate", _TS),
        ("items", T.ArrayType(ANALYTICS_ITEM)),
        ("totalPaymentValue", MONEY),
        ("primaryPaymentType", _S),
        ("reviewScore", _I),
        ("deliveryDelayDays", _I),
        ("totalItemValue", MONEY),
        ("itemCount", _I),
    ),
    "seller_performance": _table(
        ("sellerId", _S),
        ("sellerCity", _S),
        ("sellerState", _S),
        ("totalOrders", _I),
        ("totalRevenue", MONEY),
        ("avgReviewScore", _D),
        ("totalProductsSold", _I),
        ("onTimeDeliveryRate", _D),
        ("lastUpdated", _TS),
    ),
    "revenue_metrics": _table(
        ("_id", _S),
        ("window_start", _TS),
        ("window_end", _TS),
        ("category", _S),
        ("revenue", _D),
        ("order_count", _L),
        ("avg_order_value", _D),
    ),
    "customer_segments": _table(
        ("_id", _S),
        ("recency_days", _I),
        ("frequency", _L),
        ("monetary", _D),
        ("rfm_segment", _S),
        ("churn_probability", _D),
        ("recommended_products", T.ArrayType(_S)),
    ),
}
