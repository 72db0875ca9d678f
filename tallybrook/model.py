"""Record schemas and the fixed values every operator shares.

Frames carry the record envelope (`key`, `topic`, `partition`, `offset`,
`timestamp`) next to the payload columns. `timestamp` is the record's own clock:
windows, ordering and as-of lookups use it, never `placed_at`.
"""

from pyspark.sql import types as T

# Fixed values.
TIERS = ("FREE", "PRO", "ENTERPRISE")
DEFAULT_CURRENCY = "EUR"
UNIT_AMOUNT_CENTS = 4242
WINDOW = "5 minutes"
WINDOW_MS = 300_000
RETENTION_MS = 86_700_000
SEED_CURRENCIES = ("HUF", "EUR", "USD")
SEED_PROFILES = (
    ("alice", "HU", "FREE"),
    ("bob", "HU", "PRO"),
    ("carol", "FR", "PRO"),
    ("david", "US", "ENTERPRISE"),
)
ORDERS_TOPIC = "orders-placed"
PROFILES_TOPIC = "customer-profiles"
WINDOWS_TOPIC = "orders-per-window"

DIMS = ["customer_id", "tier", "currency"]
WINDOW_KEY = [*DIMS, "window_start", "window_end"]

ENVELOPE_FIELDS = [
    T.StructField("key", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
]

ORDER_FIELDS = [
    T.StructField("order_id", T.StringType(), nullable=False),
    T.StructField("customer_id", T.StringType(), nullable=False),
    T.StructField("amount_cents", T.LongType(), nullable=False),
    T.StructField("currency", T.StringType(), metadata={"default": DEFAULT_CURRENCY}),
    T.StructField("placed_at", T.TimestampType(), nullable=False),
]

PROFILE_FIELDS = [
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("tier", T.StringType()),
]

ORDER_PAYLOAD = T.StructType(ORDER_FIELDS)
ORDERS = T.StructType([*ENVELOPE_FIELDS, *ORDER_FIELDS])
# `deleted` marks a null-valued record (tombstone) of the compacted topic.
PROFILES = T.StructType(
    [*ENVELOPE_FIELDS, *PROFILE_FIELDS, T.StructField("deleted", T.BooleanType())]
)

REGISTRY_DUMP = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("global_id", T.LongType()),
        T.StructField("content_id", T.LongType()),
        T.StructField("field", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("has_default", T.BooleanType()),
    ]
)

METRIC_SAMPLES = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("instance", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)
