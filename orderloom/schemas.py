"""Declared schemas: raw log, clean set, star tables, stream message."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TS, _B = T.TimestampType(), T.BooleanType()

RAW = _struct(
    ("event_id", _S),
    ("event_time", _S),
    ("order_id", _S),
    ("customer", _struct(("customer_id", _S), ("country", _S))),
    (
        "order",
        _struct(
            ("device", _S),
            ("channel", _S),
            ("main_category", _S),
            ("n_items", _L),
            ("basket_value", _D),
            ("shipping_fee", _D),
            ("discount", _D),
            ("order_total", _D),
            ("is_returned", _L),
        ),
    ),
)

# Flat event: what flattening RAW yields, after typing.
EVENT = _struct(
    ("event_id", _S),
    ("event_time", _TS),
    ("order_id", _S),
    ("customer_customer_id", _S),
    ("customer_country", _S),
    ("order_device", _S),
    ("order_channel", _S),
    ("order_main_category", _S),
    ("order_n_items", _L),
    ("order_basket_value", _D),
    ("order_shipping_fee", _D),
    ("order_discount", _D),
    ("order_order_total", _D),
    ("order_is_returned", _B),
)

# The clean set: flat event plus derived columns (19 columns).
CLEAN = T.StructType(
    EVENT.fields
    + _struct(
        ("event_year", _I),
        ("event_month", _I),
        ("event_day", _I),
        ("event_hour", _I),
        ("price_average_per_item", _D),
    ).fields
)

# Every message field arrives as text and is cast one by one, so a single bad
# value cannot blank its neighbours.
MESSAGE_FIELDS = tuple(f.name for f in EVENT.fields)
MESSAGE_REQUIRED = ("event_id", "order_id", "customer_customer_id")

ID_COLUMNS = ("event_id", "order_id", "customer_customer_id")
LOWER_COLUMNS = ("order_device", "order_channel", "order_main_category")
CATEGORY_COLUMNS = ("customer_country",) + LOWER_COLUMNS
MONEY_COLUMNS = (
    "order_basket_value",
    "order_shipping_fee",
    "order_discount",
    "order_order_total",
)
TIME_PART_COLUMNS = ("event_year", "event_month", "event_day", "event_hour")
NUMERIC_COLUMNS = ("order_n_items",) + MONEY_COLUMNS + TIME_PART_COLUMNS + ("price_average_per_item",)

CUSTOMER_COLUMNS = ("customer_customer_id", "customer_country")
ORDER_COLUMNS = (
    "order_id",
    "customer_customer_id",
    "order_device",
    "order_channel",
    "order_main_category",
    "order_n_items",
    "order_basket_value",
    "order_shipping_fee",
    "order_discount",
    "order_order_total",
    "order_is_returned",
    "price_average_per_item",
)
EVENT_COLUMNS = ("event_id", "event_time") + TIME_PART_COLUMNS + ("order_id", "customer_customer_id")
PREDICTION_COLUMNS = ("event_id", "order_id", "customer_customer_id", "return_proba")

STAR_KEYS = {
    "customers": "customer_customer_id",
    "orders": "order_id",
    "events": "event_id",
    "predictions": "event_id",
}

# Raw inputs of the return model, before encoding and scaling.
MODEL_FEATURES = (
    CATEGORY_COLUMNS
    + ("order_n_items",)
    + MONEY_COLUMNS
    + ("price_average_per_item",)
    + TIME_PART_COLUMNS
)
