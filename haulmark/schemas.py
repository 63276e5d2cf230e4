"""Fixed schemas of messages and tables. Every field is nullable."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())])

DRIVER_PING = T.StructType(
    [
        T.StructField("driver_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)

# A delivery update as it travels: the id under either of two names, and the
# place as text, so that both an object and a plain place name survive.
DELIVERY_MESSAGE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("delivery_id", T.StringType()),
        T.StructField("driver_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("location", T.StringType()),
        T.StructField("estimated_arrival", T.TimestampType()),
        T.StructField("delay_reason", T.StringType()),
        T.StructField("delay_minutes", T.IntegerType()),
    ]
)

# The same message as the counts read it.
DELIVERY_STATE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("delivery_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("driver_id", T.StringType()),
    ]
)

DELIVERY_UPDATE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("driver_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("location", POINT),
        T.StructField("location_text", T.StringType()),
        T.StructField("estimated_arrival", T.TimestampType()),
        T.StructField("delay_reason", T.StringType()),
        T.StructField("delay_minutes", T.IntegerType()),
    ]
)

TRAFFIC_UPDATE = T.StructType(
    [
        T.StructField("area_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("traffic_density", T.StringType()),
        T.StructField("average_speed", T.DoubleType()),
        T.StructField("incidents", T.IntegerType()),
        T.StructField("weather_condition", T.StringType()),
    ]
)

# The JSON value of an alert record.
ALERT = T.StructType(
    [
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("delay_minutes", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

KEY_VALUE = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

# A stored alert record lies below its date.
ALERT_RECORD = T.StructType([*KEY_VALUE.fields, T.StructField("event_date", T.DateType())])

STATUS_COUNT = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("delivery_count", T.LongType()),
        T.StructField("kpi_calculated_at", T.TimestampType()),
    ]
)

MESSAGE = T.StructType([T.StructField("value", T.BinaryType())])

PARTITION_OFFSET = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("end_offset", T.LongType()),
        T.StructField("committed_offset", T.LongType()),
    ]
)


def with_event_date(schema: T.StructType) -> T.StructType:
    """The schema of a stored table: the processing stamp and the date folder added."""
    return T.StructType(
        [
            *schema.fields,
            T.StructField("processed_at", T.TimestampType()),
            T.StructField("event_date", T.DateType()),
        ]
    )
