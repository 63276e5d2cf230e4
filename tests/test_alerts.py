from datetime import timedelta

import frames as f
from frames import one, rows_of
from pyspark.sql import functions as F

from haulmark.operators import alerts as al
from haulmark.schemas import KEY_VALUE

MINUTE = timedelta(minutes=1)


def raised(spark, rows, at_least=60):
    return al.all_alerts(f.updates(spark, rows), at_least)


def test_threshold_is_inclusive_and_an_update_may_raise_both(spark):
    rows = [
        f.update("late", "in_transit", 60),
        f.update("fine", "in_transit", 59),
        f.update("both", "cancelled", 90),
        f.update("gone", "cancelled", None),
        f.update("none", None, None),
    ]
    got = rows_of(raised(spark, rows).select("order_id", "anomaly_type", "delay_minutes"))
    assert got == sorted(
        [("late", "high_delay", 60), ("both", "high_delay", 90), ("both", "cancellation", 90),
         ("gone", "cancellation", None)],
        key=repr,
    )
    updates = f.updates(spark, rows)
    single = al.high_delay_alerts(updates, 60).unionByName(al.cancellation_alerts(updates))
    assert rows_of(single) == rows_of(al.all_alerts(updates, 60))


def test_records_round_trip_and_other_keys_are_left(spark):
    alerts = raised(spark, [f.update("a", "cancelled", 90), f.update("b", "delivered", 61, MINUTE)])
    others = spark.createDataFrame([("driver:1", '{"anomaly_type":"high_delay"}'), ("alerts", "{}"), (None, "{}")], KEY_VALUE)
    records = al.alert_records(alerts).unionByName(others)
    back = al.active_alerts(records).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert rows_of(back.drop("key")) == rows_of(alerts)
    assert records.select("key").distinct().count() == 6


def test_broken_records_stay_alone(spark):
    records = spark.createDataFrame(
        [("alert:1", "junk"), ("alert:2", None), ("alert:3", '{"order_id":"x","anomaly_type":null}'),
         ("alert:4", '{"order_id":"y","anomaly_type":"odd"}')], KEY_VALUE)
    got = {r.key: (r.anomaly_type, r.order_id) for r in al.active_alerts(records).collect()}
    assert got == {"alert:1": ("unknown", None), "alert:2": ("unknown", None),
                   "alert:3": ("unknown", "x"), "alert:4": ("odd", "y")}


def test_messages(spark):
    alerts = spark.createDataFrame(
        [("high_delay", "O1", 75), ("cancellation", "O2", None), ("odd", "O3", 1), ("high_delay", "O4", None)],
        "anomaly_type string, order_id string, delay_minutes int",
    )
    got = {r.order_id: r.message for r in al.alert_messages(alerts).collect()}
    assert got == {"O1": "🚨 High Delay: Order O1 - 75 min", "O2": "❌ Cancellation: Order O2"}


def test_latest_are_newest_first_with_ties_by_id(spark):
    rows = [f.update(name, "cancelled", None, ago) for name, ago in
            [("a", MINUTE), ("b", 3 * MINUTE), ("c", MINUTE), ("d", 9 * MINUTE), ("e", 0 * MINUTE), ("f", 5 * MINUTE)]]
    got = [r.order_id for r in al.latest_alerts(raised(spark, rows)).collect()]
    assert got == ["e", "c", "a", "b", "f"]
    assert one(al.latest_alerts(raised(spark, rows), 1)).order_id == "e"
