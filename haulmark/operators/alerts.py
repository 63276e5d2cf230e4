"""Alerts raised from delivery updates, stored by key, and read back."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.functions.columns import CANCELLATION, HIGH_DELAY, UNKNOWN, alert_message
from haulmark.functions.messages import ISO_MICROS, json_text
from haulmark.functions.moments import DATE_SLACK, EVENT_DATE, moment, newer_than
from haulmark.schemas import ALERT
from haulmark.sources.tables import records_with_prefix

# Fixed value: the key prefix of alert records.
KEY_PREFIX = "alert:"

#: Stands for a missing part of a key.
MISSING = "none"

ALERT_COLUMNS = ("anomaly_type", "order_id", "delay_minutes", "timestamp")


def _is_late(min_delay_minutes: int) -> Column:
    return F.col("delay_minutes") >= min_delay_minutes


def _is_cancelled() -> Column:
    return F.col("status") == "cancelled"


def high_delay_alerts(updates: DataFrame, min_delay_minutes: int) -> DataFrame:
    return updates.where(_is_late(min_delay_minutes)).select(
        F.lit(HIGH_DELAY).alias("anomaly_type"), *ALERT_COLUMNS[1:]
    )


def cancellation_alerts(updates: DataFrame) -> DataFrame:
    return updates.where(_is_cancelled()).select(
        F.lit(CANCELLATION).alias("anomaly_type"), *ALERT_COLUMNS[1:]
    )


def all_alerts(updates: DataFrame, min_delay_minutes: int) -> DataFrame:
    """One row per update and alert type; an update may raise both.

    One pass without a shuffle, on a table or on an append stream. Nulls go after the
    explode, not by a lambda before it, which would leave generated code.
    """
    late, cancelled = _is_late(min_delay_minutes), _is_cancelled()
    kinds = F.array(F.when(late, HIGH_DELAY), F.when(cancelled, CANCELLATION))
    raised = updates.where(late | cancelled).select(
        F.explode(kinds).alias("anomaly_type"), *ALERT_COLUMNS[1:]
    )
    return raised.where(F.col("anomaly_type").isNotNull())


def alert_records(alerts: DataFrame, *, dated: bool = False) -> DataFrame:
    """Alerts as key/value records, ``alert:<type>:<order>:<time>`` and JSON.

    The time keeps repeated alerts of an order apart; what is missing reads ``none``.
    ``dated`` adds the date of the alert, the folder column of stored records.
    """
    parts = [F.col("anomaly_type"), F.col("order_id"), F.date_format("timestamp", ISO_MICROS)]
    own = F.concat_ws(":", *[F.coalesce(part, F.lit(MISSING)) for part in parts])
    return alerts.select(
        F.concat(F.lit(KEY_PREFIX), own).alias("key"),
        json_text(F.struct(*ALERT_COLUMNS)).alias("value"),
        *([F.to_date("timestamp").alias(EVENT_DATE)] if dated else []),
    )


def active_alerts(
    records: DataFrame, within: timedelta | None = None, as_of: datetime | Column | None = None
) -> DataFrame:
    """The alerts among key/value records; a missing type reads ``unknown``.

    ``within`` keeps alerts raised after ``as_of - within``; of records stored by date only
    those folders are read.
    """
    if within is not None and EVENT_DATE in records.columns:
        bound = moment(as_of, T.TimestampType()) - F.lit(within)
        records = records.where(F.col(EVENT_DATE) >= F.date_sub(F.to_date(bound), DATE_SLACK))
    found = records_with_prefix(records, KEY_PREFIX, ALERT)
    if within is not None:
        found = found.where(newer_than(found, within, as_of))
    return found.withColumn("anomaly_type", F.coalesce("anomaly_type", F.lit(UNKNOWN)))


def latest_alerts(alerts: DataFrame, n: int = 5) -> DataFrame:
    """The newest alerts; equal times go by order id, then type.

    Each task keeps ``n`` rows, so nothing is sorted as a whole.
    """
    return alerts.orderBy(
        F.desc_nulls_last("timestamp"), F.desc("order_id"), F.desc("anomaly_type")
    ).limit(n)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """A line of text for each alert that has one, its other columns kept."""
    lines = alerts.withColumn("message", alert_message(F.col("anomaly_type")))
    return lines.where(F.col("message").isNotNull())
