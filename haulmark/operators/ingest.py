"""Messages to table rows: parse, bring to one shape, stamp. No shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions.messages import parsed, point_in
from haulmark.schemas import DELIVERY_MESSAGE, DELIVERY_STATE, DRIVER_PING, TRAFFIC_UPDATE


def stamped(frame: DataFrame) -> DataFrame:
    """``processed_at`` added: one time per micro-batch."""
    return frame.withColumn("processed_at", F.current_timestamp())


def dated(frame: DataFrame, time: str = "timestamp") -> DataFrame:
    """``event_date`` added, the folder column of stored tables."""
    return frame.withColumn("event_date", F.to_date(time))


def driver_pings(messages: DataFrame, *, corrupt: str | None = None) -> DataFrame:
    return parsed(messages, DRIVER_PING, corrupt=corrupt)


def delivery_updates(messages: DataFrame, *, corrupt: str | None = None) -> DataFrame:
    """Delivery updates with one order id, and the place both as text and as a point."""
    raw = parsed(messages, DELIVERY_MESSAGE, corrupt=corrupt)
    return raw.select(
        F.coalesce("order_id", "delivery_id").alias("order_id"),
        "driver_id",
        "customer_id",
        "status",
        "timestamp",
        point_in(F.col("location")).alias("location"),
        F.col("location").alias("location_text"),
        "estimated_arrival",
        "delay_reason",
        "delay_minutes",
        *([corrupt] if corrupt else []),
    )


def delivery_states(messages: DataFrame) -> DataFrame:
    """The few fields the counts need; the parser skips the others."""
    raw = parsed(messages, DELIVERY_STATE)
    return raw.select(
        F.coalesce("order_id", "delivery_id").alias("order_id"), "status", "timestamp", "driver_id"
    )


def traffic_updates(messages: DataFrame, *, corrupt: str | None = None) -> DataFrame:
    return parsed(messages, TRAFFIC_UPDATE, corrupt=corrupt)
