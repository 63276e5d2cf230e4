"""The ``events`` test table in the roles of the fleet tables and streams.

One event is one driver ping, one delivery update and one traffic update. Each
function maps a frame, batch or stream; columns nobody asks for are pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.columns import (
    AREA_ID,
    CUSTOMER_ID,
    DRIVER_ID,
    ORDER_ID,
    minutes_after,
    padded_id,
    point,
    rescaled,
    rescaled_around,
)
from haulmark.sources.messages import replay

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

PING_STATUS = {"view": "idle", "click": "moving", "error": "moving", "signup": "pickup", "purchase": "dropoff"}
DELIVERY_STATUS = {
    "purchase": "delivered",
    "click": "in_transit",
    "signup": "picked_up",
    "view": "assigned",
    "error": "cancelled",
}
DENSITY = {"click": "low", "view": "medium", "signup": "high", "purchase": "very_high", "error": "very_high"}
WEATHER = {0: "clear", 1: "rain", 2: "fog", 3: "storm"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream, in one batch. The brackets make the path a glob: a file
    source takes a glob over one file, or over a folder of files, but no plain file."""
    return replay(spark, f"{sf_dir}/event[s].parquet", events(spark, sf_dir).schema)


def with_stream_time(frame: DataFrame) -> DataFrame:
    """Event time as an instant, which a watermark needs; the session zone is UTC."""
    return frame.withColumn("ts", F.col("ts").cast("timestamp"))


def _chosen(value: Column, names: dict) -> Column:
    choice = None
    for key, name in names.items():
        choice = F.when(value == key, name) if choice is None else choice.when(value == key, name)
    return choice


def fraction() -> Column:
    return F.col("value") / F.lit(1000.0)


def minutes() -> Column:
    return F.from_json("props", "k int")["k"]


def latitude() -> Column:
    return rescaled_around(fraction(), 40.7128, 0.1)


def longitude() -> Column:
    return rescaled_around(fraction(), -74.0060, 0.1)


def pings(frame: DataFrame) -> DataFrame:
    return frame.select(
        padded_id(DRIVER_ID, F.col("user_id")).alias("driver_id"),
        latitude().alias("latitude"),
        longitude().alias("longitude"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("speed"),
        rescaled(fraction(), 0.0, 360.0).alias("heading"),
        _chosen(F.col("event_type"), PING_STATUS).alias("status"),
    )


def updates(frame: DataFrame) -> DataFrame:
    """Delays are whole minutes, zero for small values and missing for assigned orders."""
    delay = F.when(F.col("event_type") != "view", F.floor("value").cast("int"))
    return frame.select(
        padded_id(ORDER_ID, F.col("event_id")).alias("order_id"),
        padded_id(DRIVER_ID, F.col("user_id")).alias("driver_id"),
        padded_id(CUSTOMER_ID, F.col("user_id")).alias("customer_id"),
        _chosen(F.col("event_type"), DELIVERY_STATUS).alias("status"),
        F.col("ts").alias("timestamp"),
        point(latitude(), longitude()).alias("location"),
        minutes_after(F.col("ts"), minutes()).alias("estimated_arrival"),
        F.when(delay >= 60, "traffic").alias("delay_reason"),
        delay.alias("delay_minutes"),
    )


def traffic(frame: DataFrame) -> DataFrame:
    return frame.select(
        padded_id(AREA_ID, F.col("user_id") % 50 + 1).alias("area_id"),
        F.col("ts").alias("timestamp"),
        _chosen(F.col("event_type"), DENSITY).alias("traffic_density"),
        F.col("value").alias("average_speed"),
        (minutes() % 4).alias("incidents"),
        _chosen(minutes() % 4, WEATHER).alias("weather_condition"),
    )


def plain_times(frame: DataFrame) -> DataFrame:
    """Instants back to times without a zone, the type the tables have."""
    times = [name for name, kind in frame.dtypes if kind == "timestamp"]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})
