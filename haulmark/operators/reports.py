"""Reports on stored pings and updates for a given moment.

Each takes the table, the moment (``None`` is now) and the span it looks back.
Only the columns a report needs are read, and its time bound is pushed to the scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.functions.columns import mean_or_zero
from haulmark.functions.moments import newer_than, on_day_of

AsOf = datetime | Column | None

# How far each report looks back.
ACTIVE_WITHIN = timedelta(minutes=5)
POSITIONS_WITHIN = timedelta(minutes=2)
DELAY_WITHIN = timedelta(hours=1)
TREND_WITHIN = timedelta(hours=24)

POSITION_COLUMNS = ("driver_id", "latitude", "longitude", "speed", "status")


def active_drivers(pings: DataFrame, as_of: AsOf = None, within: timedelta = ACTIVE_WITHIN) -> DataFrame:
    """Distinct drivers with a recent ping that is not idle. A null status is no proof
    of activity and does not count."""
    recent = pings.where(newer_than(pings, within, as_of) & (F.col("status") != "idle"))
    return recent.agg(F.count_distinct("driver_id").alias("active_drivers"))


def deliveries_today(updates: DataFrame, as_of: AsOf = None) -> DataFrame:
    today = updates.where(on_day_of(updates, as_of) & (F.col("status") == "delivered"))
    return today.agg(F.count(F.lit(1)).alias("deliveries_today"))


def avg_delay(updates: DataFrame, as_of: AsOf = None, within: timedelta = DELAY_WITHIN) -> DataFrame:
    """Mean of the positive recent delays to one decimal, 0 when there are none."""
    late = updates.where(newer_than(updates, within, as_of) & (F.col("delay_minutes") > 0))
    return late.agg(mean_or_zero(F.avg("delay_minutes")).alias("avg_delay"))


def kpi_record(
    pings: DataFrame,
    updates: DataFrame,
    alerts: DataFrame,
    as_of: AsOf = None,
    *,
    active_within: timedelta = ACTIVE_WITHIN,
    delay_within: timedelta = DELAY_WITHIN,
) -> DataFrame:
    """Active drivers, deliveries of the day, mean delay and alerts in one row.

    Each table is scanned once. The two numbers on updates share a scan bounded by
    either span of time; the one-row results are stacked and folded, not joined.
    """
    today, recent = on_day_of(updates, as_of), newer_than(updates, delay_within, as_of)
    delivered = today & (F.col("status") == "delivered")
    late = recent & (F.col("delay_minutes") > 0)
    parts = [
        active_drivers(pings, as_of, active_within),
        updates.where(today | recent).agg(
            F.count_if(delivered).alias("deliveries_today"),
            mean_or_zero(F.avg(F.when(late, F.col("delay_minutes")))).alias("avg_delay"),
        ),
        alert_count(alerts),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(name).alias(name) for name in rows.columns])


def recent_positions(
    pings: DataFrame, as_of: AsOf = None, within: timedelta = POSITIONS_WITHIN
) -> DataFrame:
    """All pings of the last minutes, not only the newest of each driver."""
    return pings.where(newer_than(pings, within, as_of)).select(*POSITION_COLUMNS)


def hourly_trend(updates: DataFrame, as_of: AsOf = None, within: timedelta = TREND_WITHIN) -> DataFrame:
    """Updates of every status and their mean delay per hour, oldest first.

    Zero delays count in the mean, missing ones do not. Hours without rows are absent.
    """
    kind = updates.schema["timestamp"].dataType
    hour = F.date_trunc("hour", "timestamp").cast(kind)
    return (
        updates.where(newer_than(updates, within, as_of))
        .groupBy(hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("deliveries"), F.avg("delay_minutes").alias("avg_delay"))
        .orderBy("hour")
    )


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("active_alerts"))
