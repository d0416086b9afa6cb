"""Schemas of the streams and tables, and the fixed values of the event contract."""

from pyspark.sql import types as T

# The four event types a cart knows.
ADD = "add_to_cart"
REMOVE = "remove_item"
UPDATE = "update_quantity"
CHECKOUT = "checkout"
EVENT_TYPES = [ADD, REMOVE, UPDATE, CHECKOUT]

# Defaults of absent fields.
DEFAULT_QUANTITY = 1
DEFAULT_PRICE = 0.0
DEFAULT_SESSION = ""

# Operating settings.
ALLOWED_LATENESS_SECONDS = 300
DEDUP_TTL_HOURS = 24
RETENTION_DAYS = 30

EVENT_FIELDS = [
    "event_id",
    "user_id",
    "event_type",
    "product_id",
    "product_name",
    "quantity",
    "price",
    "timestamp",
    "session_id",
]

# What a producer puts on the wire; the timestamp travels as ISO-8601 text.
WIRE_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("session_id", T.StringType()),
    ]
)

# A decoded event: arrival sequence and arrival time are the only clocks the operators read.
ARRIVAL = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("arrived_at", T.TimestampType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("session_id", T.StringType()),
    ]
)

RAW_MESSAGE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("arrived_at", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)

# The columns of the fact table.
FACT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("processing_lag", T.LongType()),
        T.StructField("is_late", T.ShortType()),
        T.StructField("hour_of_day", T.ShortType()),
        T.StructField("day_of_week", T.ShortType()),
        T.StructField("cart_total_before", T.DecimalType(10, 2)),
        T.StructField("cart_total_after", T.DecimalType(10, 2)),
    ]
)
