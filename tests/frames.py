"""The sample rows of the tests."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

AS_OF = datetime(2024, 3, 10, 12, 0, 0)

PING_ROWS = [
    ("D001", 18.5204, 73.8567, 45.0, "active", AS_OF),
    ("D002", 18.5304, 73.8467, 30.0, "active", AS_OF),
    ("D003", 18.5104, 73.8667, 0.0, "idle", AS_OF),
]
UPDATE_ROWS = [
    ("O001", "D001", "delivered", 5, AS_OF),
    ("O002", "D002", "delivered", 0, AS_OF),
    ("O003", "D003", "in_transit", 10, AS_OF),
]

PINGS = (
    "driver_id string, latitude double, longitude double, speed double, status string, "
    "timestamp timestamp_ntz"
)
UPDATES = "order_id string, driver_id string, status string, delay_minutes int, timestamp timestamp_ntz"


def pings(spark, rows=PING_ROWS, schema=PINGS):
    return spark.createDataFrame(rows, schema)


def updates(spark, rows=UPDATE_ROWS, schema=UPDATES):
    return spark.createDataFrame(rows, schema)


def ping(driver="D", status="active", ago=timedelta(0)):
    return (driver, 1.0, 2.0, 3.0, status, AS_OF - ago)


def update(order="O", status="delivered", delay=None, ago=timedelta(0)):
    return (order, "D", status, delay, AS_OF - ago)


def messages(spark, texts):
    rows = [(None if t is None else bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(rows, T.StructType([T.StructField("value", T.BinaryType())]))


def one(frame):
    (row,) = frame.collect()
    return row


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
