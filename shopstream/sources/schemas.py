"""Event and master-table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


ITEM = _struct({"product_id": _S, "quantity": _I, "price": _D})

# Header fields, then body fields of all topics together.
HEADER = {
    "event_id": _S,
    "event_version": _S,
    "event_type": _S,
    "event_timestamp": _S,
    "producer": _S,
    "source": _S,
}
BODY = {
    "customer_id": _S,
    "session_id": _S,
    "order_id": _S,
    "product_id": _S,
    "warehouse_id": _I,
    "search_query": _S,
    "category": _S,
    "device": _S,
    "country": _S,
    "quantity": _I,
    "unit_price": _D,
    "cart_value": _D,
    "total_amount": _D,
    "item_count": _I,
    "currency": _S,
    "payment_method": _S,
    "payment_status": _S,
    "amount": _D,
    "items": T.ArrayType(ITEM),
    "status": _S,
    "rating": _I,
    "review_text": _S,
    "old_quantity": _I,
    "new_quantity": _I,
    "campaign": _S,
}

EVENT_FIELDS = _struct(HEADER | BODY)
EVENT_SCHEMA = _struct(HEADER | BODY | {CORRUPT: _S})

# Fields each event version brought.
VERSION_FIELDS = {"1.0": [], "1.1": ["device"], "2.0": ["campaign"]}

# Topic that carries each event type.
TOPIC_OF = {
    "search": "search-events",
    "product_view": "product-view-events",
    "add_to_cart": "cart-events",
    "remove_from_cart": "cart-events",
    "checkout_started": "checkout-events",
    "payment_completed": "payment-events",
    "payment_failed": "payment-events",
    "order_completed": "order-events",
    "review_submitted": "review-events",
    "inventory_updated": "inventory-events",
    "fraud_detected": "fraud-alerts",
}

# Key whose events keep their order within a topic.
KEY_OF = {
    "search-events": "customer_id",
    "product-view-events": "customer_id",
    "cart-events": "customer_id",
    "checkout-events": "order_id",
    "payment-events": "order_id",
    "order-events": "order_id",
    "review-events": "product_id",
    "inventory-events": "product_id",
}

# Columns read from the raw master files.
RAW_CUSTOMERS = _struct({"customer_id": _S, "customer_unique_id": _S, "customer_city": _S, "customer_state": _S})
RAW_PRODUCTS = _struct(
    {
        "product_id": _S,
        "product_category_name": _S,
        "product_weight_g": _D,
        "product_length_cm": _D,
        "product_height_cm": _D,
        "product_width_cm": _D,
    }
)
RAW_TRANSLATION = _struct({"product_category_name": _S, "product_category_name_english": _S})
RAW_ITEMS = _struct({"product_id": _S, "price": _D})
RAW_SELLERS = _struct({"seller_id": _S, "seller_city": _S, "seller_state": _S})

# The five warehouses.
WAREHOUSE_SCHEMA = _struct({"warehouse_id": _I, "warehouse_name": _S, "city": _S, "region": _S, "capacity_units": _I})
WAREHOUSES = [
    (1, "Sao Paulo Hub Central", "sao paulo", "Southeast", 500000),
    (2, "Rio de Janeiro Distribution Center", "rio de janeiro", "Southeast", 350000),
    (3, "Curitiba Southern Depot", "curitiba", "South", 200000),
    (4, "Salvador Northeastern Hub", "salvador", "Northeast", 250000),
    (5, "Brasilia Federal Terminal", "brasilia", "Central-West", 300000),
]

ALERT_COLUMNS = [
    "alert_id",
    "event_timestamp",
    "customer_id",
    "order_id",
    "risk_score",
    "rule_violated",
    "details",
]
