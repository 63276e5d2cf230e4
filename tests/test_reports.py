from datetime import datetime, timedelta, timezone

import frames as f
import pytest
from frames import AS_OF, one, rows_of
from pyspark.sql import functions as F

from haulmark.functions.moments import latest_time
from haulmark.operators import reports as r

SECOND = timedelta(seconds=1)
LTZ_PINGS = f.PINGS.replace("_ntz", "")
LTZ_UPDATES = f.UPDATES.replace("_ntz", "")


def test_sample_rows(spark):
    pings, updates = f.pings(spark), f.updates(spark)
    assert one(r.active_drivers(pings, AS_OF)).active_drivers == 2
    assert r.recent_positions(pings, AS_OF).count() == 3
    assert one(r.deliveries_today(updates, AS_OF)).deliveries_today == 2
    assert one(r.avg_delay(updates, AS_OF)).avg_delay == 7.5
    trend = one(r.hourly_trend(updates, AS_OF))
    assert tuple(trend) == (AS_OF, 3, 5.0)


def test_zero_delays_count_in_the_trend_only(spark):
    updates = f.updates(spark, f.UPDATE_ROWS[:2])
    assert one(r.avg_delay(updates, AS_OF)).avg_delay == 5.0
    assert one(r.hourly_trend(updates, AS_OF)).avg_delay == 2.5


def test_lower_bound_is_strict_and_the_future_passes(spark):
    rows = [
        f.ping("edge", ago=r.ACTIVE_WITHIN),
        f.ping("inside", ago=r.ACTIVE_WITHIN - SECOND),
        f.ping("future", ago=-timedelta(days=400)),
    ]
    assert one(r.active_drivers(f.pings(spark, rows), AS_OF)).active_drivers == 2


def test_null_status_is_not_active(spark):
    rows = [f.ping("a", None), f.ping("b", "idle"), f.ping("c"), f.ping("c"), f.ping(None)]
    assert one(r.active_drivers(f.pings(spark, rows), AS_OF)).active_drivers == 1


def test_today_is_the_calendar_day(spark):
    rows = [
        f.update(ago=timedelta(hours=12)),  # midnight
        f.update(ago=timedelta(hours=12) + SECOND),  # the day before
        f.update(ago=-timedelta(hours=12) + SECOND),  # last second of the day
        f.update(ago=-timedelta(hours=12)),  # the day after
        f.update(status="in_transit"),
    ]
    assert one(r.deliveries_today(f.updates(spark, rows), AS_OF)).deliveries_today == 2


def test_positions_keep_every_ping_of_a_driver(spark):
    rows = [f.ping("a"), f.ping("a", ago=SECOND), f.ping("a", ago=r.POSITIONS_WITHIN)]
    got = r.recent_positions(f.pings(spark, rows), AS_OF)
    assert got.count() == 2 and got.columns == ["driver_id", "latitude", "longitude", "speed", "status"]


def test_trend_is_ordered_and_leaves_hours_out(spark):
    hours = [5, 1, 3, 1]
    rows = [f.update(delay=None if h == 3 else h, ago=timedelta(hours=h)) for h in hours]
    got = [tuple(x) for x in r.hourly_trend(f.updates(spark, rows), AS_OF).collect()]
    assert got == [
        (AS_OF - timedelta(hours=5), 1, 5.0),
        (AS_OF - timedelta(hours=3), 1, None),
        (AS_OF - timedelta(hours=1), 2, 1.0),
    ]


def alerts(spark, n):
    return spark.range(n).select(F.lit("x").alias("anomaly_type"))


def test_record_equals_the_single_reports(spark):
    rows = [f.update(str(n), s, d, timedelta(hours=h))
            for n, (s, d, h) in enumerate([("delivered", 5, 0), ("delivered", 70, 2), ("in_transit", 8, 0),
                                           ("delivered", None, 0), ("cancelled", 3, 30), (None, 4, 0)])]
    pings, updates = f.pings(spark), f.updates(spark, rows)
    got = one(r.kpi_record(pings, updates, alerts(spark, 4), AS_OF)).asDict()
    assert got == {
        "active_drivers": one(r.active_drivers(pings, AS_OF))[0],
        "deliveries_today": one(r.deliveries_today(updates, AS_OF))[0],
        "avg_delay": one(r.avg_delay(updates, AS_OF))[0],
        "active_alerts": 4,
    }
    assert got["deliveries_today"] == 3 and got["avg_delay"] == 5.7


def test_empty_tables_give_zero(spark):
    pings, updates = f.pings(spark, []), f.updates(spark, [])
    got = one(r.kpi_record(pings, updates, alerts(spark, 0), AS_OF))
    assert tuple(got) == (0, 0, 0.0, 0)
    assert r.hourly_trend(updates, AS_OF).count() == 0
    assert latest_time(updates) is None


@pytest.mark.parametrize("schema", [f.UPDATES, LTZ_UPDATES])
def test_now_is_the_default(spark, schema):
    at = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [("O", "D", "delivered", 4, at), ("P", "D", "delivered", 9, at - timedelta(days=3))]
    assert one(r.avg_delay(f.updates(spark, rows, schema))).avg_delay == 4.0


def test_instants_and_zoned_moments(spark):
    pings = f.pings(spark, schema=LTZ_PINGS)
    for moment in [AS_OF, AS_OF.replace(tzinfo=timezone.utc),
                   AS_OF.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=5, minutes=30)))]:
        assert one(r.active_drivers(pings, moment)).active_drivers == 2
    late = AS_OF + r.ACTIVE_WITHIN
    assert one(r.active_drivers(pings, late)).active_drivers == 0
    assert one(r.active_drivers(pings, F.lit(AS_OF.isoformat()).cast("timestamp"))).active_drivers == 2


@pytest.mark.parametrize("schema", [f.PINGS, LTZ_PINGS])
def test_latest_time_is_exact(spark, schema):
    at = datetime(2024, 3, 10, 12, 0, 0, 123457)
    pings = f.pings(spark, [f.ping(), ("x", 1.0, 1.0, 1.0, "s", at), ("n", 1.0, 1.0, 1.0, "s", None)], schema)
    newest = latest_time(pings)
    assert newest.replace(tzinfo=None) == at
    assert one(r.active_drivers(pings, newest)).active_drivers == 2


def test_date_folders_are_pruned_and_results_stay(spark, tmp_path):
    rows = [f.update(str(n), "delivered", n, timedelta(hours=6 * n)) for n in range(200)]
    flat = f.updates(spark, rows)
    path = str(tmp_path / "updates")
    flat.withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    for report in (r.deliveries_today, r.avg_delay, r.hourly_trend):
        assert rows_of(report(stored, AS_OF)) == rows_of(report(flat, AS_OF))
    got = r.hourly_trend(stored, AS_OF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    day = (AS_OF - r.TREND_WITHIN - timedelta(days=2)).date()
    assert str(day) in plan
