"""Column names, types and fixed values shared by the operators."""

from pyspark.sql import types as T

EVENT_TIME = "event_time"
EVENT_TYPE = "event_type"
PRODUCT = "product_id"
SESSION = "user_session"
USER = "user_id"

# Landed events also have the month of their file, a partition, and the day of the event.
MONTH = "month"
EVENT_DATE = "event_date"

VIEW = "view"
PURCHASE = "purchase"

PRODUCT_ATTRIBUTES = ["category_code", "brand", "price"]

RAW_COLUMNS = [
    "event_time", "event_type", "product_id", "category_id", "category_code",
    "brand", "price", "user_id", "user_session",
]

# Files carry text only; types are given by one projection (sources.events).
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# Event times are UTC wall clock without a zone, so no result depends on the session time zone.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_session", T.StringType()),
    ]
)

LANDED_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField(EVENT_DATE, T.DateType()),
        T.StructField(MONTH, T.StringType()),
    ]
)

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("user_session", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("purchased", T.IntegerType()),
        T.StructField("num_views_product", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("num_views_session", T.LongType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("start_weekday", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("num_prev_sessions", T.LongType()),
        T.StructField("num_prev_product_views", T.LongType()),
    ]
)
FEATURE_COLUMNS = FEATURE_SCHEMA.fieldNames()
